"""Fixed values that results depend on, in one place."""

# Format, protocol and standards names that stay as they are in every language.
TECH_TOKENS = [
    "PDF", "DOCX", "DOC", "XLSX", "XLS", "PPTX", "PPT", "EPUB", "CSV", "TXT", "JSON", "HTML", "XML", "IDML", "INDD", "PNG", "JPG",
    "JPEG", "SVG", "WEBP", "MP4", "ZIP", "OCR", "GDPR", "SSL", "TLS", "API", "SDK", "URL", "HTTP", "HTTPS", "SEO", "CSS", "RSS",
]

# Lower-cased tokens left out of content-word counts.
BRAND_TOKENS = ["pdf", "docx", "xlsx", "pptx", "epub", "csv", "txt", "json", "html", "xml", "ocr", "gdpr", "ssl", "api", "url", "seo"]

# Words that may stand twice in a row.
DOUBLES = ["ha", "ja", "no", "si", "sí", "que", "très", "muito", "bem"]

# Locales in a non-Latin script, and those whose script is compact.
NON_LATIN = [
    "ru", "uk", "bg", "sr", "mk", "be", "kk", "ky", "mn", "el", "he", "ar", "fa", "ur", "ps", "hi", "bn", "pa", "gu", "ta", "te", "kn",
    "ml", "mr", "ne", "si", "th", "lo", "my", "km", "ka", "hy", "am", "zh", "zh-tw", "ja", "ko", "yi", "sd", "ug",
]
COMPACT = ["zh", "zh-tw", "ja", "ko", "th", "lo", "my", "km"]
RTL = ["ar", "fa", "he", "ur", "ps", "sd", "ug", "yi"]

# Elements of running text, elements without prose, elements without an end tag.
INLINE = [
    "a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "data", "dfn", "em", "i", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strong", "sub", "sup", "time", "u", "var", "wbr", "img", "picture", "source",
]
SKIP = ["script", "style", "noscript", "code", "pre", "template", "svg"]
VOID = ["br", "img", "wbr", "source", "input", "hr", "meta", "link"]

# Attributes, meta keys and JSON-LD keys that hold text for readers.
TEXT_ATTRS = ["alt", "title", "placeholder", "aria-label", "aria-description"]
META_KEYS = [
    "description", "og:title", "og:description", "og:site_name", "og:image:alt", "twitter:title", "twitter:description", "twitter:image:alt",
    "apple-mobile-web-app-title",
]
JSONLD_KEYS = ["name", "description", "headline", "text", "alternateName", "caption", "slogan"]

# Roles by element, attribute and meta key.
BLOCK_ROLES = {
    "button": "button", "a": "button", "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading",
    "title": "page title", "label": "form label", "legend": "form label", "summary": "expander label", "th": "table header",
    "figcaption": "caption", "option": "menu option", "optgroup": "menu option",
}
ATTR_ROLES = {
    "attr:alt": "image alt text", "attr:placeholder": "input placeholder", "attr:aria-label": "accessible label",
    "attr:aria-description": "accessible description", "attr:title": "tooltip",
}
META_ROLES = {
    "description": "meta description", "og:description": "social share description", "twitter:description": "social share description",
    "og:title": "social share title", "twitter:title": "social share title", "og:site_name": "site name", "og:image:alt": "image alt text",
    "twitter:image:alt": "image alt text",
}

# Currency symbols, longest first, and their codes.
CURRENCIES = {
    "CA$": "CAD", "A$": "AUD", "NZ$": "NZD", "HK$": "HKD", "R$": "BRL", "US$": "USD", "$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY",
    "₹": "INR", "₽": "RUB", "₩": "KRW", "₺": "TRY", "₴": "UAH", "zł": "PLN", "Kč": "CZK", "R": "ZAR",
}

# Weights of severities and the labels of error categories.
SEVERITY = {"minor": 1, "major": 5, "critical": 10}
CATEGORIES = [
    "accuracy/mistranslation", "accuracy/omission", "accuracy/addition", "accuracy/untranslated", "fluency/grammar", "fluency/spelling",
    "fluency/register", "fluency/awkward", "terminology/inconsistent", "terminology/glossary", "locale/number-date-currency", "style/tone",
    "markup/placeholder",
]

# Batch sizes, sampling and thresholds.
BATCH, JUDGE_BATCH, RETRIES, CHECKPOINT_EVERY = 40, 10, 5, 10
COVERAGE_FLOOR, CHURN_HINT, JUDGED_FLOOR, GATE_PAGES = 99.0, 15.0, 80.0, 25
SAMPLE, SEED, SHARES = 100, 20260829, (0.5, 0.25, 0.25)
PAGE_TYPES = ["WebPage", "AboutPage", "ContactPage", "FAQPage", "CollectionPage", "ItemPage"]
