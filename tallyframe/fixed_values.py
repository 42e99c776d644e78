"""Values that must equal the reference's for results to match.

Everything here is a constant of the reference's data model or of its data
preparation, stated as plain values in their natural order.  Constants that
only belong to this repository's binding of the test tables live in
:mod:`tallyframe.sources.testdata`.
"""

# fixed values: ticket type (matched case-insensitively) -> ticket category
TICKET_CATEGORY_MAP = {
    "technical issue": "App/device sync issue",
    "billing inquiry": "Billing & subscription question",
    "product inquiry": "Program/feature question",
    "cancellation request": "Cancellation request",
    "refund request": "Refund request",
}

# fixed values: an active day has at least this many very + moderately active minutes
ACTIVE_MINUTES_THRESHOLD = 15

# fixed values: accepted values of the declared column tests
ACCOUNT_TYPES = ["organization", "individual"]
ACCOUNT_STATUSES = ["active"]
ELIGIBILITY_STATUSES = ["enrolled"]
PLAN_TIERS = ["standard", "premium"]
SUBSCRIPTION_STATUSES = ["active"]
DATA_SOURCES = ["real_fitbit", "synthetic"]
ORDER_TYPES = ["coaching_session", "challenge_entry_fee", "fitness_assessment", "virtual_event_ticket"]
ORDER_STATUSES = ["completed", "refunded", "canceled"]
TICKET_CATEGORIES = ["App/device sync issue", "Billing & subscription question", "Program/feature question",
                     "Cancellation request", "Refund request"]
CHANNELS = ["paid_social", "search_ads", "email", "referral_program", "content_seo", "sales_outreach",
            "employer_partnership", "trade_show", "linkedin_ads"]
AUDIENCES = ["individual", "organization"]
CAMPAIGN_STATUSES = ["completed", "active"]

# fixed values: data preparation
SEED = 42
ACTIVITY_WINDOW_DAYS = 60                     # shared engagement window
JITTER_BP = 1500                              # resampled measures vary by +/- 15 %
MILES_TO_KM = 1.60934                         # statute mile in kilometres
ATTRIBUTED_SHARE = "0.55"                     # share of accounts given an acquiring campaign
DELAYED_CONVERSION_DAYS = 45                  # grace after a campaign ends
DAYS_PER_MONTH = 30                           # membership length in months
PLAN_TIER_WEIGHTS = (["standard", "premium"], ["0.75", "0.25"])
ORDERS_PER_MEMBER_WEIGHTS = ([1, 2, 3, 4], ["0.50", "0.30", "0.15", "0.05"])

# fixed values: ticket resolution (priority keyword -> min and max days, checked in this order)
RESOLUTION_DAYS_BY_PRIORITY = [("critical", (0, 1)), ("high", (1, 3)), ("medium", (2, 5)), ("low", (3, 10))]
DEFAULT_RESOLUTION_DAYS = (2, 6)
RESOLVED_STATUS_KEYWORDS = ("closed", "resolved")

# fixed values: campaign labels
THEMES = ["New Year Reset", "Summer Movement", "Back to Routine", "Spring Momentum",
          "Q1 Push", "Q2 Growth", "Q3 Expansion", "Q4 Renewal", "Referral Boost",
          "Habit Streak", "Fresh Start", "Year-End Wellness"]
LABEL_SEPARATOR = " — "
