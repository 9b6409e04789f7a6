"""Word lists, codes, thresholds and message texts that results depend on."""

# fixed values: countries treated as high risk
HIGH_RISK_COUNTRIES = ["NG", "RU", "CN", "BR", "IN", "PH", "ID", "VN"]

# fixed values: channel codes
CHANNEL_CODES = {"POS": 0, "ATM": 1, "ONLINE": 2, "MOBILE": 3, "BRANCH": 4}

# fixed values: transaction type codes
TXN_TYPE_CODES = {"PURCHASE": 0, "WITHDRAWAL": 1, "TRANSFER": 2, "DEPOSIT": 3, "PAYMENT": 4, "REFUND": 5}

UNKNOWN_CODE = 99

# fixed values: merchant category code -> category, id, risk level, risk score, parent, cash equivalent
MERCHANT_CATEGORIES = [
    ("5411", "grocery_stores", 1, "low", 0.1, "retail", False),
    ("5812", "eating_places_restaurants", 2, "medium", 0.3, "dining", False),
    ("5814", "fast_food_restaurants", 3, "low", 0.2, "dining", False),
    ("5912", "drug_stores_pharmacies", 4, "low", 0.1, "healthcare", False),
    ("5311", "department_stores", 5, "low", 0.15, "retail", False),
    ("5541", "service_stations", 6, "medium", 0.35, "automotive", False),
    ("5942", "book_stores", 7, "low", 0.1, "retail", False),
    ("6011", "atm_cash_disbursements", 8, "high", 0.7, "financial", True),
    ("6012", "financial_institutions", 9, "high", 0.65, "financial", True),
    ("7011", "hotels_motels_resorts", 10, "medium", 0.4, "travel", False),
    ("4511", "airlines", 11, "medium", 0.45, "travel", False),
    ("7995", "gambling", 12, "critical", 0.9, "entertainment", True),
    ("5999", "miscellaneous_retail", 13, "medium", 0.5, "retail", False),
]
UNKNOWN_CATEGORY = ("unknown", 999, "high", 0.8, "uncategorized", False)
RISK_ORDINALS = {"low": 0, "medium": 1, "high": 2, "critical": 3}
UNKNOWN_RISK_ORDINAL = 2

# fixed values: percentile edges of the amount bins and their labels
AMOUNT_PERCENTILES = [0, 10, 25, 50, 75, 90, 95, 99, 100]
AMOUNT_LABELS = ["micro", "small", "low", "medium", "high", "large", "very_large", "extreme"]

# fixed values: alert severity by score, with the recommended action
SEVERITY_STEPS = [
    (0.9, "CRITICAL", "Block transaction and contact customer immediately"),
    (0.8, "HIGH", "Block transaction and request verification"),
    (0.7, "MEDIUM", "Flag for manual review within 1 hour"),
]
LOWEST_SEVERITY = ("LOW", "Monitor account for suspicious activity")

# fixed values: text inside a lower-cased risk factor -> alert type
ALERT_TYPES = {
    "high_velocity": "VELOCITY",
    "unusual_location": "GEOGRAPHIC",
    "distance_anomaly": "GEOGRAPHIC",
    "high_amount": "HIGH_VALUE",
    "amount_outlier": "HIGH_VALUE",
    "pattern_anomaly": "PATTERN",
    "behavioral_anomaly": "BEHAVIORAL",
    "blacklist_match": "BLACKLIST",
    # names that the risk rules really emit
    "impossible_travel": "GEOGRAPHIC",
    "high_risk_location": "GEOGRAPHIC",
    "new_merchant": "BEHAVIORAL",
    "new_device": "BEHAVIORAL",
}
DEFAULT_ALERT_TYPE = "PATTERN"

# fixed values: reply words
POSITIVE_WORDS = ["yes", "y", "ok", "great", "thanks", "thank", "love", "awesome", "confirm", "interested", "buy", "want", "order", "1"]
NEGATIVE_WORDS = ["no", "n", "stop", "cancel", "unsubscribe", "hate", "spam", "never", "remove", "delete", "quit", "end", "0"]
OPT_OUT_REPLIES = ["STOP", "UNSUBSCRIBE", "CANCEL", "END", "QUIT"]
CONFIRM_REPLIES = ["YES", "Y", "CONFIRM", "OK", "1"]

# fixed values: words that mark a phrase as a service problem
PROBLEM_WORDS = ["wait", "slow", "problem", "issue", "frustrated"]

# fixed values: call quality points
CALL_BASE_POINTS = 50
OVERALL_POINTS = {"POSITIVE": 30, "NEUTRAL": 15, "MIXED": 5, "NEGATIVE": -10}
CUSTOMER_POINTS = {"POSITIVE": 20, "NEUTRAL": 10, "MIXED": 0, "NEGATIVE": -15}

# fixed values: file extensions by document type
EXTENSIONS = {
    "pdf": ["pdf"],
    "image": ["jpg", "jpeg", "png", "gif", "bmp", "tiff", "webp"],
    "audio": ["mp3", "wav", "flac", "ogg", "m4a", "wma", "aac"],
    "text": ["txt", "md", "csv", "json", "xml", "html"],
}

# fixed values: prices per unit of processing, USD
UNIT_PRICES = {
    "textract": 0.0015,
    "comprehend": 0.0001,
    "rekognition": 0.001,
    "transcribe": 0.024,
    "sagemaker": 0.0001,
    "bedrock_input": 0.000003,
    "bedrock_output": 0.000015,
}

# fixed values: columns that identify a patient or tell their health state
PATIENT_COLUMNS = ["patient_id", "diagnosis", "notes_summary"]

# fixed values: sentence ends tried in this order when a chunk is cut
SENTENCE_ENDS = [". ", ".\n", "? ", "?\n", "! ", "!\n"]

# fixed values: limits above (below, for hours since the last one) which a transaction is labelled as fraud by rule
WEAK_LABEL_LIMITS = {"amount_zscore": 3.0, "new_merchant_amount": 1000, "distance_from_last": 500, "time_since_last": 1, "tx_count_1h": 10}

# fixed values: risk factor names and their conditions
RISK_FACTORS = {
    "HIGH_AMOUNT": "amount_zscore > 2.0",
    "HIGH_VELOCITY": "tx_count_1h > 5",
    "NEW_MERCHANT": "is_new_merchant = 1",
    "NEW_DEVICE": "is_new_device = 1",
    "HIGH_RISK_LOCATION": "is_high_risk_country = 1",
    "IMPOSSIBLE_TRAVEL": "distance_from_last > 100 AND time_since_last < 1",
    "WEEKEND_TX": "is_weekend = 1",
    "ODD_HOURS": "hour_of_day < 6 OR hour_of_day > 22",
}

# fixed values: limits and texts of the advice on negative calls
ADVICE_CALLS, ADVICE_ENTITY_MENTIONS, ADVICE_PHRASE_MENTIONS = 50, 5, 3
ADVICE_VOLUME = "High volume of negative calls (%d). Consider reviewing agent training programs."
ADVICE_ENTITY = "'%s' mentioned in %d negative calls. Investigate related issues."
ADVICE_PHRASE = "'%s' appears frequently in negative calls. Review related processes."
ADVICE_NONE = "No critical issues detected. Continue monitoring call quality."
