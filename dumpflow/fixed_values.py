"""Codes, word lists, patterns and names that results depend on.

Everything here must keep its exact value for results to agree with existing
data sets. Logic lives elsewhere.
"""

# --- fixed values: pageview codes -------------------------------------------
ACCESS_CODES = {"desktop": 0, "mobile-app": 1, "mobile-web": 2, "all-access": 3}
AGENT_CODES = {"user": 0, "spider": 1, "bot": 2, "automated": 3, "all-agents": 4}
UNKNOWN_CODE = -1

# --- fixed values: namespaces left out of pageview counts --------------------
EXCLUDED_PREFIXES = (
    "Special", "Talk", "User", "User_talk", "Wikipedia", "Wikipedia_talk",
    "File", "File_talk", "MediaWiki", "MediaWiki_talk", "Template",
    "Template_talk", "Help", "Help_talk", "Category", "Category_talk",
    "Portal", "Portal_talk", "Draft", "Draft_talk", "TimedText",
    "TimedText_talk", "Module", "Module_talk", "Gadget", "Gadget_talk",
    "Gadget_definition", "Gadget_definition_talk",
)

# --- fixed values: why a line was not kept -----------------------------------
EMPTY_LINE = "empty_lines"
INVALID_FORMAT = "invalid_format"
WIKI_NOT_ALLOWED = "wiki_code_not_allowed"
EXCLUDED_PREFIX = "excluded_prefix"
ZERO_PAGEVIEWS = "zero_pageviews"

# --- fixed values: clickstream ------------------------------------------------
NAVIGATION_TYPES = ("link", "external", "other")
REFERER_HOSTS = (
    ("google.", "other-google"),
    ("yahoo.", "other-yahoo"),
    ("bing.", "other-bing"),
    ("facebook.", "other-facebook"),
    ("twitter.", "other-twitter"),
)
REFERER_ARTICLE = "article"
REFERER_OTHER = "other-other"
REFERER_EMPTY = "other-empty"

# --- fixed values: dates in dump file names, first match wins ----------------
FILE_DATE_PATTERNS = (
    r"pageviews-(\d{4})(\d{2})(\d{2})(?:-[a-z]+)?\.bz2",
    r"pagecounts-(\d{4})-(\d{2})-(\d{2})-\d{6}\.gz",
    r"clickstream-\w+-(\d{4})-(\d{2})\.tsv(?:\.gz)?",
    r"\w+-(\d{4})(\d{2})(\d{2})-\w+\.gz",
    r"\w+-(\d{4})(\d{2})(\d{2})-\w+\.sql",
    r"\w+-(\d{4})(\d{2})(\d{2})-[\w-]+\.(?:xml|sql)",
    r"/(\d{4})(\d{2})/.*",
)

# --- fixed values: dump file names on disk and in index pages ----------------
LOCAL_FILE_PATTERNS = {
    "pageviews": r"^pageviews-\d{8}-[^/]+\.bz2$",
    "clickstream": r"^clickstream-([a-z][a-z0-9_]*)-\d{4}-\d{2}\.tsv\.gz$",
    "revisions": r"^([a-z][a-z0-9_]*)-\d{8}-(?:stub-meta-history|stub-meta-current|stub-articles)\.xml\.gz$",
    "pagelinks": r"^([a-z][a-z0-9_]*)-\d{8}-pagelinks\.sql\.gz$",
}
INDEX_LINK_PATTERNS = {
    "pageviews": r'href="(pageviews-\d{8}-[^"]+\.bz2)"',
    "clickstream": r'href="(clickstream-[a-z][a-z0-9_]*-\d{4}-\d{2}\.tsv\.gz)"',
    "revisions": r'href="/[a-z][a-z0-9_]*/\d{8}/([a-z][a-z0-9_]*-\d{8}-(?:stub-meta-history|stub-meta-current|stub-articles)\.xml\.gz)"',
    "pagelinks": r'href="/[a-z][a-z0-9_]*/\d{8}/([a-z][a-z0-9_]*-\d{8}-pagelinks\.sql\.gz)"',
}
INDEX_DATE_PATTERN = r'href="(\d{8})/"'
HREF_PATTERN = r'href="([^"]+)"'
TIME_BASED_TYPES = ("pageviews", "clickstream")
WIKI_BASED_TYPES = ("revisions", "pagelinks")

# --- fixed values: where dumps are published ----------------------------------
BASE_URLS = {
    "pageviews": "https://dumps.wikimedia.org/other/pageview_complete/",
    "clickstream": "https://dumps.wikimedia.org/other/clickstream/",
    "revisions": "https://dumps.wikimedia.org/{wiki_code}/",
    "pagelinks": "https://dumps.wikimedia.org/{wiki_code}/",
}

# --- fixed values: message topics and keys ------------------------------------
TOPIC_SCHEMAS = {
    "clickstream_topic": "ClickStream",
    "pageview_topic": "PageView",
    "wikidocument_topic": "WikiDocument",
    "revision_data_topic": "RevisionData",
    "outbound_pagelinks_topic": "OutboundPageLinks",
    "inbound_pagelinks_topic": "InboundPageLinks",
    "pageinfo_topic": "PageInfo",
}
PARTITION_KEYS = {
    "PageView": ("page_hash", "year_month"),
    "ClickStream": ("page_hash", "year_month"),
    "OutboundPageLinks": ("year_month", "tuple_struct.pl_from"),
    "InboundPageLinks": ("year_month", "tuple_struct.pl_target_id"),
    "RevisionData": ("page_hash", "year_month"),
    "WikiDocument": ("page_hash", "wiki_code", "year_month"),
    "TitleIdMapping": ("page_hash", "year_month"),
    "PageInfo": ("page_hash", "year_month"),
}

# --- fixed values: page document ----------------------------------------------
DOCUMENT_KEY_FIELDS = ("page_hash", "year_month", "tuple_struct")
REVISIONS = "revisions"
PAGEVIEWS = "pageviews"
CLICKS_IN = "clickstreams_in"
CLICKS_OUT = "clickstreams_out"
LINKS_IN = "pagelinks_inbound"
LINKS_OUT = "pagelinks_outbound"
TITLES = "historical_titles"
ELEMENT_KINDS = (REVISIONS, PAGEVIEWS, CLICKS_IN, CLICKS_OUT, LINKS_IN, LINKS_OUT, TITLES)
