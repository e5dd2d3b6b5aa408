"""Patterns, formats, thresholds, names and labels that results depend on."""

# Access-log layout.
ACCESS_LINE = r'^\S+ - - \[\d{2}/\w+/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4}\] "\w+ .* HTTP/\d\.\d" \d+ \d+.*$'
BRACKETED = r"\[(.*?)\]"
VERB = r'"(\w+) '
URL = r'"(?:\w+) (.*?) HTTP'
PROTOCOL = r"HTTP/\d\.\d"
PRODUCT_ID = r"id=(\d+)"
STATUS_AFTER_REQUEST = r'" (\d+) '
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
STATUS_TOKEN = 8
SIZE_TOKEN = 9
PREVIEW_CHARS = 100

# Continuous log metrics.
ERROR_STATUSES = (404, 500)
ERROR_WINDOW = "5 minutes"
ERROR_WATERMARK = "5 minutes"
PRODUCT_WINDOW = "1 minute"
PRODUCT_WATERMARK = "1 minute"
PRODUCT_THRESHOLD = 20
CLIENT_WINDOW = "1 minute"
CLIENT_WATERMARK = "1 minute"
CLIENT_THRESHOLD = 100
TOPIC = "logs"

# Learning events and scored entities.
LEARNING_COLUMNS = ("pseudo", "contexte", "composant", "evenement")
SCORE_FLOOR = 0.0
SCORE_CEILING = 20.0
PASS_LABEL = "Réussi"
FAIL_LABEL = "Échec"
SUMMARY_LABELS = (
    "Date et heure (UTC)",
    "Utilisateur",
    "Nombre d'étudiants",
    "Moyenne des notes (/20)",
    "Note minimale",
    "Note maximale",
    "Taux de réussite",
    "Probabilité moyenne de réussite",
)

# Price table.
RATIO_LIMIT = 30000

# Survey profiling and classification.
TOP_FEATURES = 6
CORRELATION_THRESHOLD = 0.2
POSITIVE_LABEL = "Diabétique"
NEGATIVE_LABEL = "Non-diabétique"

# Training.
SEED = 42
TEST_PERCENT = 20
FOREST_TREES = 100
FOREST_DEPTH = 15
BOOSTING_ROUNDS = 100
GRID_ROUNDS = (100, 200, 300)
GRID_RATES = (0.05, 0.1, 0.2)
GRID_DEPTHS = (3, 5, 7)
FOLDS = 5
