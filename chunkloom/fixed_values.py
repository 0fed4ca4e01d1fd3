"""Texts, limits and patterns that stored data and clients depend on."""

# Dates and limits
SENTINEL_DATE = "2000-01-01"
RECENT_DAYS = 7
RECENT_LIMIT = 8
CATALOGUE_LIMIT = 24
TOP_K = 12
CONTEXT_CHARS = 5000
MAX_SENTENCES = 7
MIN_NORM = 1e-6
MIDPOINT_MARGIN = 0.2
JDBC_BATCH_SIZE = 1000

# Column names
REQUIRED_COLUMNS = ("video_id", "chunk_id", "text")
EMBEDDING_NAMES = ("embedding", "emb", "vector", "embeddings")

# URLs
SHORT_LINK_PREFIX = "https://youtu.be/"
SHORT_LINK_HOST = "youtu.be"
EMBED_PREFIX = "https://www.youtube.com/embed/"
VIDEO_QUERY_KEY = "v"

# Generated-text clean-up
EMPTY_CONTENT = "(내용 없음)"
SUMMARY_MARKER = "### 요약:"
HEADING_WORDS = ("답변", "요약", "질문", "명령어", "입력", "맥락", "응답")
ROLE_WORDS = ("system", "user", "assistant")
CHAT_OPEN, CHAT_CLOSE = "<|im_start|>", "<|im_end|>"

# Every character that counts as white space when text is stripped or split
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Letters and digits of every script survive normalisation, all else is removed
NOT_LETTER_OR_DIGIT = r"[^\p{L}\p{N}]+"

# Four-digit year, one- or two-digit month and day
COMPACT_DATE = r"^(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])$"
