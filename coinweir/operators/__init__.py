"""DataFrame-to-DataFrame operators. None reads or writes a file or runs a job."""
