"""Names and word lists that results must spell exactly this way."""

# Feed names, in rising authority.
WEBHOOK = "webhook"
RECONCILIATION = "reconciliation"

# The accepted event type and the keys an accepted event must carry.
ACCEPTED_EVENT_TYPE = "transaction.created"
REQUIRED_EVENT_KEYS = ("id", "account_id", "amount", "currency", "created")

# Reject reasons.
REJECT_BAD_JSON = "Invalid JSON"
REJECT_BAD_TYPE = "Unsupported event type"
REJECT_MISSING = "Missing fields: "

# Reject reasons of deliveries that cannot be filed or read back.
REJECT_BAD_TIME = "Unreadable created time"
REJECT_MISFIT = "Transaction does not fit the schema"

# Accepted currencies and the known category vocabulary.
CURRENCIES = ("GBP",)
CATEGORIES = (
    "general",
    "eating_out",
    "expenses",
    "groceries",
    "bills",
    "entertainment",
    "transport",
    "holidays",
    "family",
    "personal_care",
    "shopping",
    "cash",
    "transfers",
    "income",
    "gifts",
    "finances",
    "savings",
)

# The published marts, in presentation order.
MARTS = ("spend_by_category", "monthly_cashflow", "merchant_summary", "subscriptions")

# Labels of reconciliation findings.
RAW_NOT_STAGED = "in_raw_but_not_in_stg_transactions"
STAGED_NOT_RAW = "in_stg_transactions_but_not_in_raw"
MODEL_NOT_PUBLISHED = "in_stg_transactions_but_not_published_to_staging"
PUBLISHED_NOT_MODEL = "published_to_staging_but_not_in_stg_transactions"
PUBLISHED_TWICE = "duplicated_across_staging_partitions"

# Names of the mart-to-fact sum checks.
CHECK_NET = "monthly_cashflow.net vs fct_transactions.amount"
CHECK_SPLIT = "monthly_cashflow income - expenses vs net"
CHECK_SPEND = "spend_by_category.total_spend vs fct_transactions debit spend"
CHECK_COUNT = "spend_by_category.transaction_count vs fct_transactions debit count"
CHECK_MERCHANT = "merchant_summary.total_spend vs fct_transactions merchant debit spend"
