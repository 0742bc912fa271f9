"""Lists, patterns and dimensions that results depend on."""

from __future__ import annotations

# --- fixed values: URLs -------------------------------------------------------------
TRACKING_KEYS = r"utm_.*|ref|referrer|source|fbclid|gclid|mc_cid|mc_eid|ncid|igshid|share|amp|__twitter_impression|s|si"
PATH_PLATFORMS = """
medium.com dev.to hashnode.com hackernoon.com telegra.ph substack.com notion.site gitbook.io readthedocs.io
blogspot.com livejournal.com wordpress.com tumblr.com buttondown.email world.hey.com hey.com notion.so write.as
tinyletter.com mataroa.blog beehiiv.com ghost.io omg.lol neocities.org codeberg.page srht.site
""".split()
SUBDOMAIN_PLATFORMS = """
substack.com wordpress.com tumblr.com ghost.io bearblog.dev hashnode.dev svbtle.com posthaven.com micro.blog
notion.site hatenablog.com hatenadiary.jp netlify.app vercel.app pages.dev surge.sh neocities.org gitbook.io
webflow.io onrender.com fly.dev workers.dev glitch.me repl.co
""".split()
GENERIC_SEGMENTS = "p tag search feed s m post posts blog archive".split()
DENIED_HOSTS = """
twitter.com x.com facebook.com instagram.com linkedin.com reddit.com old.reddit.com news.ycombinator.com lobste.rs
youtube.com youtu.be vimeo.com twitch.tv tiktok.com bsky.app threads.net mastodon.social pinterest.com quora.com
stackoverflow.com stackexchange.com superuser.com serverfault.com askubuntu.com discord.com t.me imgur.com
producthunt.com indiehackers.com slashdot.org digg.com
github.com gist.github.com gitlab.com bitbucket.org sourceforge.net codeberg.org sr.ht git.sr.ht npmjs.com pypi.org
crates.io rubygems.org packagist.org nuget.org hub.docker.com dockerhub.com codepen.io jsfiddle.net replit.com
observablehq.com kaggle.com huggingface.co
wikipedia.org en.wikipedia.org wikimedia.org wiktionary.org developer.mozilla.org w3.org ietf.org rfc-editor.org
iso.org unicode.org khronos.org ecma-international.org archive.org web.archive.org wikidata.org
arxiv.org biorxiv.org medrxiv.org ssrn.com jstor.org sciencedirect.com springer.com link.springer.com nature.com
science.org pnas.org plos.org journals.plos.org ieee.org ieeexplore.ieee.org dl.acm.org acm.org semanticscholar.org
researchgate.net pubmed.ncbi.nlm.nih.gov ncbi.nlm.nih.gov papers.nips.cc proceedings.neurips.cc openreview.net
amazon.com ebay.com aliexpress.com apps.apple.com play.google.com store.steampowered.com docs.google.com
drive.google.com groups.google.com patents.google.com books.google.com scholar.google.com goo.gl bit.ly
""".split()
DENIED_SUFFIXES = [".gov", ".mil", ".edu"]
DENIED_LABELS = r"(^|\.)(login|auth|accounts|checkout|shop|store|support|status)\."
#: Suffixes under which anybody can have a name, beyond top-level domains; a full list can replace them.
PUBLIC_SUFFIXES = """
blogspot.com codeberg.page fly.dev ghost.io glitch.me netlify.app omg.lol onrender.com pages.dev readthedocs.io
repl.co srht.site vercel.app workers.dev github.io gitlab.io
co.uk org.uk ac.uk gov.uk me.uk com.au net.au org.au edu.au co.nz org.nz co.jp ne.jp or.jp ac.jp com.br org.br co.in
org.in co.za com.cn org.cn edu.cn com.tw com.hk com.sg co.kr com.mx com.ar com.tr co.il org.il
""".split()
FEED_PATHS = [
    "/feed", "/feed/", "/rss", "/rss/", "/feed.xml", "/rss.xml", "/atom.xml", "/index.xml", "/feeds/all.atom.xml",
    "/blog/feed", "/blog/rss", "/blog/index.xml", "/posts/index.xml", "/feed/atom",
]
FEED_LINK_TAG = r"""<link[^>]+type=["']application/(?:rss|atom)\+xml["'][^>]*>"""
HREF = r"""href=["']([^"']+)["']"""
FORUM_HOST = r"^(forums?|discuss|community|board|talk|answers|support)\.|\.(forums?|discourse)\.|phpbb|vbulletin|lists\."

# --- fixed values: titles -----------------------------------------------------------
YEAR_SUFFIX = r"\s*\((?:19|20)\d{2}\)\s*$"
BRACKET_TAG = r"\s*\[(pdf|video|audio|paywall|slides|2\d{3})\]\s*"
#: In this order; the first that fires decides.
KIND_RULES = [
    ("incident", r"post-?mortem|\boutage\b|\bincident\b|breach\b|CVE-\d|\bRCE\b|0-?day|backdoor|supply.chain|root cause|what went wrong|hacked|data leak"),
    ("announcement", r"^\S+ v?\d+\.\d+|\brelease[ds]?\b|announcing|introducing|now (available|open.source)|\bis out\b|\bGA\b|acquires|shuts down|has died|launches"),
    ("deep-dive", r"how .{2,30} works|under the hood|internals\b|deep dive|anatomy of|writing (a|your own)|building (a|my own)|from scratch|in \d+ lines|reverse.engineering|demystif|implementing"),
    ("opinion", r"^(Why|Stop|Don't|Should|I |We |You )|considered harmful|is (dead|broken|a mistake|underrated)|lessons (from|learned)|I was wrong|\?$"),
]
CRAFT_TITLE = r"how .{2,30} works|under the hood|internals|deep.dive|anatomy of|writing (a|your own)|building (a|my own)|from scratch|in \d+ lines|reverse.engineer|i built|i made|lessons|why i|implementing"
EVENT_TITLE = (
    r"\b(announces?|launches?|acquires?|raises?|files?|sues?|says?|reports?|confirms?|unveils?|shuts? down|lays? off|hits?|warns?|accuses?)\b"
    r"|\b(ceo|q[1-4]|billion|million|lawsuit|investors?|funding|ipo)\b"
)
REPLY_TITLE = r"(^|[•·|»–—-]\s*)(re|aw|fwd)\s*[:：]|\(tags?:\s*[\w./-]+\)"

# --- fixed values: dimensions -------------------------------------------------------
TOPICS = [
    ("systems", "Systems"), ("languages", "Languages"), ("web", "Web & Frontend"), ("data-infra", "Data & Infra"),
    ("ai", "AI & ML"), ("security", "Security"), ("hardware", "Hardware"), ("graphics-games", "Graphics & Games"),
    ("practice", "Practice"), ("science", "Science"), ("policy", "Policy"), ("society", "Society"),
]
SOFTWARE_TOPICS = [slug for slug, _ in TOPICS[:8]]
SOURCES = [
    ("personal", "Personal", False), ("engineering", "Engineering", False), ("trade", "Trade press", False),
    ("project", "Project", False), ("newsroom", "Newsroom", True), ("vendor", "Vendor", True), ("institution", "Institution", True),
]
KINDS = [("deep-dive", "How it works"), ("opinion", "Argument"), ("announcement", "Release"), ("incident", "War story")]
TOPIC_SLUGS, SOURCE_SLUGS, KIND_SLUGS = [[x[0] for x in xs] for xs in (TOPICS, SOURCES, KINDS)]
HIDDEN_SOURCES = [slug for slug, _, hidden in SOURCES if hidden]
HIDDEN_MASK = sum(1 << i for i, x in enumerate(SOURCES) if x[2])
FALLBACK_KIND = {"newsroom": "announcement", "trade": "announcement", "institution": "announcement", "vendor": "announcement", "project": "announcement", "engineering": "deep-dive"}
DAY0 = 1136073600
TOPIC_BITS, FLAG_FEED, FLAG_KIND_RULE, FLAG_DEAD = 0x0FFF, 1 << 13, 1 << 14, 1 << 15
CANARIES = """
danluu.com jvns.ca simonwillison.net rachelbythebay.com lwn.net blog.cloudflare.com antirez.com nullprogram.com
randomascii.wordpress.com lcamtuf.substack.com fgiesen.wordpress.com 0fps.wordpress.com
""".split()
