"""Thresholds, labels, word lists and sizes the results depend on."""

# Customer scoring. (limit, score); the first row that holds wins.
RECENCY_DAYS_AT_MOST = ((30, 5), (60, 4), (90, 3), (180, 2))
FREQUENCY_AT_LEAST = ((10, 5), (7, 4), (5, 3), (3, 2))
MONETARY_AT_LEAST = ((1000, 5), (500, 4), (200, 3), (100, 2))
LOWEST_SCORE = 1
SEGMENT_AT_LEAST = (
    (13, "Champions"),
    (10, "Loyal Customers"),
    (7, "Potential Loyalists"),
    (5, "At Risk"),
)
LOWEST_SEGMENT = "Lost"

# Report sizes and units.
TOP_ROWS = 10
BYTE_UNITS = ("B", "KB", "MB", "GB", "TB")
TDP_WATTS = 65.0
SECONDS_PER_HOUR = 3600
ZONES = ("raw", "processed")
FORMATS = ("csv", "json", "parquet", "orc")

# Shop tables (one order is one product line).
SHOP_SIZES = {"customers": 100_000, "products": 10_000, "orders": 1_000_000}
SHOP_PRICE_RANGES = {
    "Electronics": (50, 500),
    "Clothing": (10, 200),
    "Home": (20, 300),
    "Sports": (15, 250),
    "Books": (10, 100),
}
SHOP_AGE = {"mean": 35, "deviation": 12, "low": 18, "high": 80}
SHOP_RATING = {"mean": 4.0, "deviation": 0.8, "low": 1, "high": 5}
PARETO_SHAPE = 1.16
STOCK_RANGE = (10, 1000)
SHOP_QUANTITY_RANGE = (1, 10)
REGISTRATION_DAYS = 5 * 365
ORDER_SECONDS = 365 * 24 * 3600

# Store tables (an order header with one to five items).
STORE_SIZES = {"customers": 1_000, "products": 500, "orders": 5_000}
STORE_PRICE_RANGES = {
    "Electronics": (50, 2000),
    "Clothing": (10, 200),
    "Books": (5, 50),
    "Home & Garden": (20, 500),
    "Sports": (15, 300),
    "Toys": (5, 100),
    "Food": (1, 50),
    "Beauty": (10, 150),
    "Automotive": (25, 1000),
    "Health": (5, 200),
}
AGE_GROUPS = {
    "young": (18, 25),
    "adult": (26, 45),
    "middle": (46, 65),
    "senior": (66, 80),
}
GENDERS = ("Male", "Female", "Other")
ORDER_STATUSES = ("Pending", "Processing", "Shipped", "Delivered", "Cancelled")
PAYMENT_METHODS = ("Credit Card", "Debit Card", "PayPal", "Bank Transfer")
ACTIVE_SHARE = 0.75
COST_FACTORS = (0.3, 0.6)
WEIGHT_RANGE = (0.1, 50.0)
ITEMS_PER_ORDER = (1, 5)
STORE_QUANTITY_RANGE = (1, 5)
UNIT_PRICE_RANGE = (10, 500)
SHIPPING_RANGE = (5, 25)
TAX_PERCENT = 8
DISCOUNT_PERCENT = 10
CREATED_DAYS = 2 * 365
LOGIN_SECONDS = 30 * 24 * 3600

# Rows for the storage-format comparison.
BENCHMARK_ROWS = 500_000
BENCHMARK_CATEGORIES = (
    "Electronics", "Clothing", "Books", "Home", "Sports", "Food", "Beauty",
)
BENCHMARK_AMOUNT_RANGE = (1, 1000)
BENCHMARK_START = "2020-01-01 00:00:00"

# Word pools for readable text columns.
FIRST_NAMES = (
    "Ada", "Ben", "Carla", "Dmitri", "Elif", "Farid", "Grace", "Hugo",
    "Ines", "Jonas", "Keiko", "Liam", "Mona", "Nils", "Olga", "Pavel",
)
LAST_NAMES = (
    "Abbott", "Brandt", "Castro", "Dunn", "Eriksen", "Fischer", "Garcia",
    "Haddad", "Ito", "Jensen", "Kowalski", "Lopez", "Moreau", "Novak",
    "Okafor", "Petrov",
)
PLACES = (
    ("Lisbon", "Lisboa", "Portugal"),
    ("Osaka", "Kansai", "Japan"),
    ("Austin", "Texas", "United States"),
    ("Lyon", "Rhone", "France"),
    ("Pune", "Maharashtra", "India"),
    ("Bergen", "Vestland", "Norway"),
    ("Cusco", "Cusco", "Peru"),
    ("Ghent", "East Flanders", "Belgium"),
    ("Perth", "Western Australia", "Australia"),
    ("Leeds", "Yorkshire", "United Kingdom"),
)
STREETS = ("Oak Street", "Mill Lane", "Harbour Road", "Station Avenue", "Hill Road")
PHRASE_STARTS = ("Compact", "Classic", "Modern", "Durable", "Smart", "Light")
PHRASE_ENDS = ("Set", "Kit", "Edition", "Bundle", "Model", "Choice", "Line")
BRANDS = ("Alder & Co", "Birchline", "Cobalt Works", "Dune Supply", "Elm House")
DESCRIPTIONS = (
    "Made for daily use.",
    "Ships in recycled packaging.",
    "A favourite of returning buyers.",
    "Tested for long service.",
)
