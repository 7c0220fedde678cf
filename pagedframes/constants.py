"""Page size and parameter names must match the servers; how requests are paced is up to the reader."""

PAGE_SIZE = 200  # items per page
PAGING_PARAMS = ("items_per_page", "page")  # set by the reader, never by the caller
PAUSE_SECONDS = 0.2  # courtesy pause after each page request
TIMEOUT_SECONDS = 10.0
BACKOFF_MIN_SECONDS = 0.02
BACKOFF_MAX_SECONDS = 30.0
BACKOFF_JITTER = 0.2
MAX_RETRIES = 10

BLOCK_PAGES = 500  # pages per folder of a landing table; a choice of ours, about 40 MB
