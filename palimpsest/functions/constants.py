"""Values that must stay equal to the original workflow's for results to match.

FIXED VALUES (kept as plain text, in their natural order, in one place):
"""

# --- FIXED VALUES: tagged sidecar markers, in file order -------------------
MARKER_OCR = "OCR Text:"
MARKER_SUMMARY = "Summary:"
MARKER_DATE = "Date:"
MARKER_PRINTED = "Printed:"
MARKER_LEGIBLE = "Legible:"
TRUE_WORD = "True"
FALSE_WORD = "False"

# --- FIXED VALUES: answer extraction ----------------------------------------
DEFAULT_DATE = "No Date Provided"
ANSWER_PATTERNS = {
    "ocr_text": r'"ocr_text": "([^"]+)"',
    "summary": r'"summary": "([^"]+)"',
    "date": r'"date": "([^"]+)"',
    "is_printed": r'"is_printed": (true|false)',
    "is_legible": r'"is_legible": (true|false)',
}
JSON_FENCE_OPEN = "```json"
JSON_FENCE_CLOSE = "```"
UNKNOWN_ID = "unknown_id"
METHOD_JSON = "JSON Parsing"
METHOD_REGEX = "Regex Extraction"

# --- FIXED VALUES: request building ------------------------------------------
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/chat/completions"
REQUEST_MODEL = "gpt-4o"
REQUEST_MAX_TOKENS = 4000
BATCH_BUDGET_BYTES = 95 * 1024 * 1024
MAX_BATCHES = 200
VALID_IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png")

# --- FIXED VALUES: generation status texts -----------------------------------
BLANK_ERROR = "ERROR: Blank response generated"
NO_IMAGE_ERROR = "ERROR: Image not found"
NOTE_EMPTY = "Model produced empty output"
NOTE_VALID = "Model produced valid output"
CORRECTION_PROMPT = "Correct this OCR:: {text}"
CORRECTION_PROMPT_SPACE = "Correct this OCR: {text}"
IMAGE_PROMPT = "[INST] <image>\nGive me the text of this historical letter: {text}[/INST]"

# --- FIXED VALUES: fetch statuses and retry policy ----------------------------
FETCH_EXISTS = "Exists"
FETCH_DOWNLOADED = "Downloaded"
FETCH_FAILED = "Failed after max retries"
FETCH_MAX_ATTEMPTS = 5
FETCH_FIRST_BACKOFF_S = 1

# --- FIXED VALUES: batch ledger -----------------------------------------------
BATCH_TERMINAL = ("completed", "failed", "expired")
BATCH_RETRY_LIMIT = 60

# --- FIXED VALUES: CSV null tokens of the pandas reader -----------------------
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- FIXED VALUES: conversations --------------------------------------------------
OCR_QUESTION = "What is the OCR of this image?"
IMAGE_TOKEN = "<image>"
IMAGE_START_TOKEN = "<im_start>"
IMAGE_END_TOKEN = "<im_end>"
IGNORE_INDEX = -100
IMAGE_TOKEN_INDEX = -200
SIGNAL_BEGIN = "### "
SIGNAL_END = "\n"
IMAGE_LENGTH_BONUS = 128

# --- FIXED VALUES: arms -----------------------------------------------------------
ARM_LABELS = ("gold", "silver")
ARM_SIZES = (100, 1000, 10000)
ARM_SIZE_SHORT = {100: "100", 1000: "1k", 10000: "10k"}
TESTING_TEMPLATE = (
    "id", "transcription", "pyte_ocr", "chatgpt_ocr", "is_printed", "is_legible", "BART_untuned",
    "BART_gold_100", "BART_gold_1000", "BART_gold_10000", "BART_silver_100", "BART_silver_1000",
    "BART_silver_10000", "LLAVA_untuned", "LLAVA_gold_100", "LLAVA_gold_1000", "LLAVA_gold_10000",
    "LLAVA_silver_100", "LLAVA_silver_1000", "LLAVA_silver_10000",
)
SPLIT_SEED = 42
