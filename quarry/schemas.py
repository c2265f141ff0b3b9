"""Table schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (they must stay exactly as written for results to match).
# ---------------------------------------------------------------------------

# Entity types kept from the mention extractor, in this order.
ENTITY_TYPES = ["PERSON", "ORG", "GPE", "DATE", "EVENT", "FAC", "LOC"]

# Text cap before mention matching, and context characters on each side.
MENTION_TEXT_CAP = 10000
MENTION_CONTEXT = 60
MENTION_MIN_LENGTH = 2

# Scanned-page rule and the text-based prefilter (note: < 50 versus > 50).
SCANNED_BELOW = 50
TEXT_BASED_ABOVE = 50

# Redaction geometry: annotation type, minimum drawing size, character cell.
REDACT_ANNOT_TYPE = 12
REDACT_MIN_WIDTH = 20
REDACT_MIN_HEIGHT = 8
CHAR_CELL_WIDTH = 7
CHAR_CELL_HEIGHT = 12

# Chunking: window and step in words; excerpt length of a citation.
CHUNK_WORDS = 300
CHUNK_OVERLAP = 50
EXCERPT_CHARS = 200
DEFAULT_TOP_K = 5

# Page-size rules of the list endpoints: (default limit, cap).
LIST_LIMITS = (20, 100)
TIMELINE_LIMITS = (50, 200)
CHANGELOG_LIMITS = (20, 100)
FEED_ITEMS = 20

# Fixed top-n sizes of the profile queries.
DOC_TOP_ENTITIES = 20
ENTITY_APPEARANCES = 50
ENTITY_COOCCURRENCES = 20
MOST_REDACTED = 10

# Text of the answer path.
NO_HITS_ANSWER = "No relevant documents found."
PROMPT_TEMPLATE = (
    "Answer the question using ONLY the provided source documents.\n"
    "For every claim you make, cite the source number in brackets like [Source 1].\n"
    "If the answer is not in the documents, say \"This information was not found in the available documents.\"\n"
    "Do not use any outside knowledge.\n"
    "\n"
    "Question: %s\n"
    "\n"
    "Sources:\n"
    "%s\n"
    "\n"
    "Answer:"
)
SOURCE_HEADER = "\n[Source %d: %s, page %d]\n"

# Characters Python's str.strip()/str.split() treat as whitespace.
PY_WHITESPACE = "".join(chr(c) for c in (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# The same set as a regex character class (Java and RE2 both accept \x{..}).
PY_WHITESPACE_CLASS = ("[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{1F} \\x{85}\\x{A0}\\x{1680}"
                       "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")

# ---------------------------------------------------------------------------
# Star schema (times are zone-less, like the source tables' timestamps)
# ---------------------------------------------------------------------------


PAGE = T.StructType([
    T.StructField("page_num", T.IntegerType(), False),
    T.StructField("text", T.StringType()),
    T.StructField("redaction_count", T.IntegerType()),
    T.StructField("estimated_chars_redacted", T.IntegerType()),
    T.StructField("word_count", T.IntegerType()),
])

RAW_DOCS = T.StructType([
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("corpus", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("page_count", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("pages", T.ArrayType(PAGE)),
])


CHUNK_METADATA = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("corpus", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("page_num", T.IntegerType()),
])


MANIFEST = T.StructType([
    T.StructField("corpus", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("fetched", T.DateType()),
    T.StructField("page_count", T.IntegerType()),
])


