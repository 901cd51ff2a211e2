"""Word lists, limits, formats and texts that results depend on."""

# ---------------------------------------------------------------------------
# Article limits and scoring weights
# ---------------------------------------------------------------------------
MIN_ARTICLE_WORDS = 100
MAX_ARTICLE_TOKENS = 1000
SUMMARY_TOLERANCE = 1.1
MAX_SPAM_SCORE = 0.25

EMOJI_SHARE = 0.1
PROMO_SHARE = 0.25
EXCLAMATION_SHARE = 0.05

LOCAL_WINDOW = 3
INTRO_WEIGHTS = (1.0, 0.75, 0.5)
CONCLUSION_WEIGHTS = (0.5, 1.0)
CENTRALITY_SHARE = 0.75
INTRO_SHARE = 0.20
CONCLUSION_SHARE = 0.05
GLOBAL_SHARE = 0.7
LOCAL_SHARE = 0.3
SCALE_EPSILON = 1e-8
LENGTH_QUANTILE = 0.9

FETCH_CHUNK = 100

# ---------------------------------------------------------------------------
# Promotional words
# ---------------------------------------------------------------------------
PROMO_WORDS = """
bonus free offer deposit win prize reward
exclusive limited special click subscribe
guaranteed instant sale game 100% code
new lucky winner
""".split()

# ---------------------------------------------------------------------------
# English stop words
# ---------------------------------------------------------------------------
STOP_WORDS = """
a about above after again against ain all am an and any are aren aren't as at be because been
before being below between both but by can couldn couldn't d did didn didn't do does doesn
doesn't doing don don't down during each few for from further had hadn hadn't has hasn hasn't
have haven haven't having he he'd he'll her here hers herself he's him himself his how i i'd if
i'll i'm in into is isn isn't it it'd it'll it's its itself i've just ll m ma me mightn mightn't
more most mustn mustn't my myself needn needn't no nor not now o of off on once only or other
our ours ourselves out over own re s same shan shan't she she'd she'll she's should shouldn
shouldn't should've so some such t than that that'll the their theirs them themselves then
there these they they'd they'll they're they've this those through to too under until up ve
very was wasn wasn't we we'd we'll we're were weren weren't we've what when where which while
who whom why will with won won't wouldn wouldn't y you you'd you'll your you're yours yourself
yourselves you've
""".split()

# ---------------------------------------------------------------------------
# Code points with the Unicode Emoji property above ASCII
# ---------------------------------------------------------------------------
EMOJI_CODE_POINTS = """
00A9 00AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA
24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623
2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B
267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5
26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F
2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764
2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004
1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A
1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5
1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D
1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE
1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D9 1F6DC-1F6E5
1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 1F947-1F9FF
1FA70-1FA7C 1FA80-1FAC6 1FAC8 1FACC-1FADD 1FADF-1FAEB 1FAEF-1FAFA
""".split()


#: Signs inside compatibility forms.
PLAIN_SIGNS = {"°": "d", "′": "'", "″": '"', "‐": "-", "−": "-", "・": ".", "、": ",", "。": "."}

# ---------------------------------------------------------------------------
# Patterns. They avoid look-around, back-references and word
# boundaries so that they mean the same in every regex dialect, PHONE excepted.
# ---------------------------------------------------------------------------
WORD = r"[\p{L}\p{N}_]+"
TOKEN = r"\p{L}{1,4}|\p{N}{1,3}|[^\s\p{L}\p{N}]"
WHITESPACE = r"[ \t\r\n\f]+"
SENTENCE_END = r"([.!?])[ \t\r\n\f]+"
EXCLAMATION_RUN = r"!{2,}"
URL = r"(?i:https?://|ftp://|www[0-9]{0,3}\.)[^\s<>]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
PHONE_BODY = (
    r"(?:(?:\+?[01]|\+[0-9]{2})[ .-]?)?(?:\(?[0-9]{3,4}\)?/?[ .-]?)?"
    r"[0-9]{3}[ .-]?[0-9]{4}(?:\s?(?:ext\.?|[#x-])\s?[0-9]{2,6})?"
)
PHONE = r"(?:^|(?<=[^\w)]))" + PHONE_BODY + r"(?=\W|$)"
ASCII_PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""

# ---------------------------------------------------------------------------
# Named HTML entities; &amp; is always decoded last
# ---------------------------------------------------------------------------
HTML_ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "iexcl": "¡", "cent": "¢",
    "pound": "£", "yen": "¥", "sect": "§", "copy": "©", "laquo": "«", "reg": "®", "deg": "°",
    "plusmn": "±", "middot": "·", "raquo": "»", "frac12": "½", "iquest": "¿", "times": "×",
    "divide": "÷", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“",
    "rdquo": "”", "bull": "•", "hellip": "…", "euro": "€", "trade": "™", "rarr": "→",
    "amp": "&",
}

# ---------------------------------------------------------------------------
# HTML elements that never hold article text, and block elements
# ---------------------------------------------------------------------------
DROPPED_ELEMENTS = (
    "head script style noscript template iframe svg canvas nav footer aside form button select "
    "table figure"
).split()
BLOCK_ELEMENTS = (
    "p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd br hr article section main header blockquote pre "
    "body html"
).split()
DROPPED_CLASSES = (
    "ad ads advert advertisement banner breadcrumb comment comments cookie footer menu nav "
    "navbar navigation newsletter promo related share sharing sidebar social sponsored"
).split()

# Worth of a text block where a page marks no article: its words less these.
BLOCK_COST = 8
TAG_COST = 2

# ---------------------------------------------------------------------------
# Feed request parameters
# ---------------------------------------------------------------------------
FEED_REQUEST = {
    "tickers": "BTC",
    "items": 100,
    "type": "article",
    "sortby": "oldestfirst",
    "extra-fields": "id,rankscore",
    "metadata": 1,
    "fallback": "false",
    "page": 1,
}

# ---------------------------------------------------------------------------
# Price tickers and download window
# ---------------------------------------------------------------------------
TICKERS = """
ETH-USD SOL-USD BNB-USD XRP-USD DOGE-USD ADA-USD TON-USD AVAX-USD DOT-USD LINK-USD BTC-USD
""".split()
PRICE_WINDOW_DAYS = 365 * 2

# ---------------------------------------------------------------------------
# Analysis record vocabulary
# ---------------------------------------------------------------------------
EMOTIONS = ["Optimistic", "Fearful", "Confident", "Uncertain", "Neutral"]
EVENT_CATEGORIES = [
    "Regulation", "Adoption", "Security", "Technology", "Macro",
    "Institutional", "DeFi", "Market", "Social", "Other",
]
PRICE_DIRECTIONS = ["Upward", "Downward", "Neutral"]
TIMEFRAMES = ["within 24 hours", "within a week", "long-term"]

REQUIRED_SCORES = [
    "positive", "negative", "neutral", "emotion_intensity", "market_alignment",
    "impact_magnitude", "trend_alignment_score", "credibility_score", "virality_score",
    "event_relevance", "confidence_score",
]
OPTIONAL_SCORES = [
    "fud_score", "technical_complexity", "institutional_relevance", "retail_impact",
    "regulatory_risk", "market_maturity_alignment",
]

# ---------------------------------------------------------------------------
# Model request parameters and message texts
# ---------------------------------------------------------------------------
MODEL_NAME = "gpt-4o"
MODEL_TEMPERATURE = 0.4
MODEL_MAX_TOKENS = 3000
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/chat/completions"
CUSTOM_ID_PREFIX = "article_"

SYSTEM_MESSAGE = (
    "You are a financial sentiment analyst. Your role is to analyze crypto-related articles "
    "and provide structured assessments of their potential impact on Bitcoin prices. "
    "Analyze each article separately and provide structured results."
)

ANALYSIS_REQUIREMENTS = """
       1. Categorical Analysis:
           - Emotion Category: One of: Optimistic, Fearful, Confident, Uncertain, Neutral
           - Event Categories: A list of: Regulation, Adoption, Security, Technology, Macro, Institutional, DeFi, Market, Social, Other
           - Expected Price Direction: One of: Upward, Downward, Neutral
           - Timeframe of Impact: One of: within 24 hours, within a week, long-term
       
       2. Continuous Analysis - all values between 0.0 (minimum) and 1.0 (maximum):
            - Positive, Negative and Neutral Sentiment Scores: in total they should add up to 1
            - Emotion Intensity: How strong is the emotional content
            - Market Alignment: How aligned is this with current market trends
            - Impact Magnitude: How significant is the potential impact
            - Trend Alignment Score: How well does this align with existing trends
            - Credibility Score: How credible is the information
            - Virality Score: How likely is this to spread virally
            - Event Relevance: How relevant is this event to Bitcoin
            - Confidence Score: How confident are you in this analysis
       
       3. Additional Information:
           - Key Topics: Main topics/entities discussed in the article
           - Free Text Summary: Summarize the main points and implications of the article (5 sentences max)
           - Explain Reasoning: Explain the reasoning behind the analysis and predictions (5 sentences max)
           - Historical Analogy: Provide a historical analogy where similar events influenced the market (if applicable)
       """

# The user message is these texts in order, with the article's values between them:
# id, title, text, requirements, id.
USER_MESSAGE = (
    "Analyze the following article: \n        \n        News ID: ",
    "\n        Title: ",
    "\n        Article: ",
    "\n        \n        Provide the following details:\n        ",
    """
        
        Respond in structured JSON format, without Markdown or code block formatting:
        {
            "news_id": \"""",
    """\",
            "emotion_category": "<Optimistic | Fearful | Confident | Uncertain | Neutral>",
            "event_category": ["<Regulation | Adoption | Security | Technology | Macro | Institutional | DeFi | Market | Social | Other>"],
            "price_direction_category": "<Upward | Downward | Neutral>",
            "timeframe_category": "<within 24 hours | within a week | long-term>",
            "positive": "<float between 0.0 and 1.0>",
            "negative": "<float between 0.0 and 1.0>",
            "neutral": "<float between 0.0 and 1.0>",
            "emotion_intensity": "<float between 0.0 and 1.0>",
            "market_alignment": "<float between 0.0 and 1.0>",
            "impact_magnitude": "<float between 0.0 and 1.0>",
            "trend_alignment_score": "<float between 0.0 and 1.0>",
            "credibility_score": "<float between 0.0 and 1.0>",
            "virality_score": "<float between 0.0 and 1.0>",
            "event_relevance": "<float between 0.0 and 1.0>",
            "confidence_score": "<float between 0.0 and 1.0>",
            "key_topics": ["<str>", "..."],
            "free_text_summary": "<str>",
            "historical_analogy": "<str | null>"
        }
        """,
)
