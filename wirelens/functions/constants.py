"""Fixed values that results depend on; they are stated as they are, in their natural order."""

# Words that carry no meaning in a company or target name, by group.
STOP_TOKENS = (
    # articles and prepositions
    "the", "a", "an", "of", "in", "for", "and", "to", "from", "its", "s",
    # corporate structure
    "division", "unit", "business", "arm", "segment", "operations", "group", "industrial", "services", "company", "corp", "inc", "ltd", "plc", "ag",
    "se", "sa", "nv", "gmbh", "co", "llc", "lp", "holdings", "holding",
    # generic business words
    "solutions", "products", "systems", "technologies", "technology", "tech", "global", "international", "worldwide", "americas", "europe", "asia",
    "capital", "partners", "advisors", "advisory", "management", "investments", "portfolio", "enterprises", "resources", "consulting", "associates",
    "financial", "ventures", "fund", "funds", "equity",
    # industries
    "energy", "health", "healthcare", "medical", "pharma", "pharmaceutical", "bio", "life", "sciences", "materials", "chemicals", "digital", "data",
    "analytics", "media", "communications", "network", "networks", "logistics", "supply", "manufacturing", "engineering", "automotive", "aerospace",
    "defense", "food", "beverage",
    # common descriptors
    "north", "south", "east", "west", "new", "advanced", "specialty", "premium", "strategic", "integrated", "national",
)

# Page parts that are never body text, as element names, roles, and fragments of class names.
STRIP_TAGS = ("nav", "footer", "header", "aside", "script", "style", "noscript", "form")
STRIP_ROLES = ("navigation", "banner", "contentinfo", "complementary")
STRIP_CLASS_PARTS = ("sidebar", "nav", "footer", "header", "menu", "ad", "ads", "advertisement", "cookie", "popup", "modal", "social", "share", "comment", "comments")

# Feeds that belong to no firm, as (source, url).
CORE_FEEDS = (
    ("BusinessWire", "https://feed.businesswire.com/rss/home/?rss=G1QFDERJXkJeEFpRWw=="),
    ("Reuters M&A", "https://news.google.com/rss/search?q=site%3Areuters.com+%28%22private+equity%22+OR+buyout+OR+carve-out+OR+carveout+OR+divestiture+OR+divests+OR+%22agrees+to+acquire%22%29&hl=en-US&gl=US&ceid=US%3Aen"),
)

# Press pages of law firms, as (name, domain, press_url).
LAW_FIRMS = (
    ("Kirkland & Ellis", "kirkland.com", "https://www.kirkland.com/insights"),
    ("Simpson Thacher & Bartlett", "stblaw.com", "https://www.stblaw.com/about-us/news"),
    ("Latham & Watkins", "lw.com", "https://www.lw.com/en/news"),
    ("Paul, Weiss", "paulweiss.com", "https://www.paulweiss.com/insights/client-news"),
    ("Ropes & Gray", "ropesgray.com", "https://www.ropesgray.com/en/newsroom"),
    ("Debevoise & Plimpton", "debevoise.com", "https://www.debevoise.com/news"),
    ("Willkie Farr & Gallagher", "willkie.com", "https://www.willkie.com/news"),
    ("Gibson, Dunn & Crutcher", "gibsondunn.com", "https://www.gibsondunn.com/category/firm-news/"),
    ("Paul Hastings", "paulhastings.com", "https://www.paulhastings.com/news"),
    ("Freshfields Bruckhaus Deringer", "freshfields.com", "https://www.freshfields.com/en/our-thinking/news"),
    ("Clifford Chance", "cliffordchance.com", "https://www.cliffordchance.com/news.html"),
)

# Paths that are tried for a press page and for a feed, in order.
PRESS_PATHS = (
    "/news", "/press", "/press-releases", "/media", "/newsroom", "/news-and-insights", "/insights", "/news-media", "/press-room",
    "/media-centre", "/media-center", "/about/news", "/about/press", "/about/media", "/who-we-are/news", "/our-news", "/updates",
    "/announcements", "/portfolio-news", "/news-views", "/news-releases", "/currents", "/about-us/news-and-insights",
    "/en/news-and-views", "/en/news", "/news-insights", "/news-insights/press-releases",
)
FEED_PATHS = (
    "/feed", "/rss", "/feed/", "/rss/", "/news/feed", "/news/rss", "/press/feed", "/press/rss", "/press-releases/feed",
    "/press-releases/rss", "/media/feed", "/media/rss", "/newsroom/feed", "/insights/feed", "/news-and-insights/feed",
    "/news-views/feed", "/blog/feed",
)
PRESS_LINK_WORDS = ("/news/", "/press/", "/media/", "/insight", "release", "announce", "article")
PRESS_LINKS_NEEDED = 3
FEED_LINK_SCAN = 50_000

# reviewers' verdicts.
FALSE_POSITIVE_VERDICTS = ("Duplicate", "Low EV", "No Separation Work", "Not Relevant", "Not a Carve-Out", "Wrong Geography")
TRUE_POSITIVE_VERDICTS = ("Confirmed",)
PENDING = "Pending"

# Limits of the deal rules.
MIN_CONFIDENCE = 50
PURSUE_FROM, MONITOR_FROM = 65, 40
NO_BUYER_CAP, NO_SEPARATION_CAP = 30, 25
FIT_WEIGHTS = (("separation_complexity", 30), ("pe_buyer", 30), ("size", 15), ("sector", 15), ("geography", 10))
DEAL_TYPES = ("corporate_carveout", "portco_carveout")
STAGES = ("signing", "closing")

# State, fetching and batching.
STATE_DAYS = 14
STATE_BYTES_TO_WARN = 2_000_000
FETCH_BUDGET = 600  # seconds for all sources of a run
MISSES_TO_FLAG = 3
BODY_WORDS, MAX_WORDS, MAX_CHARS = 50, 1500, 6000
CLASSIFY_BATCH, QUALIFY_BATCH, MODEL_TRIES, REPLY_TOKENS = 20, 5, 3, 4096
PRICE_IN, PRICE_OUT = 15, 75  # per million tokens
FETCH_TIMEOUT, CONNECT_TRIES, BACKOFF = 30, 3, (1, 2)
SINK_PAUSE, SINK_TIMEOUT, SINK_TEXT = 0.35, 10, 2000
