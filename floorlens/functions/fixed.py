"""Labels, knots, rule tables and keywords.

They have to equal the published values for results to agree, so they are
stated here as plain data and nowhere else.
"""

# --- calendar labels (fixed values) ---
WEEKDAYS_FROM_SUNDAY = ["日", "月", "火", "水", "木", "金", "土"]
WEEKDAYS_FROM_MONDAY = ["月", "火", "水", "木", "金", "土", "日"]
WEEKEND = "週末"
HOLIDAY = "祝日"
WEEKDAY = "平日"
DAY_OFF = "土日祝"

# --- day categories in report order (fixed values) ---
CAT_EVENT = "LINE告知"
CAT_MONTH_END = "月末"
CAT_DIGITS = [0, 1, 6, 8, 9]
CAT_NORMAL = "通常日"
CAT_ALL = "すべての日"


def digit_category(digit):
    return f"{digit}のつく日"


CATEGORY_ORDER = (
    [CAT_EVENT, CAT_MONTH_END]
    + [digit_category(d) for d in CAT_DIGITS]
    + [CAT_NORMAL, CAT_ALL]
)

# --- streaks (fixed values) ---
STREAK_DAYS = [2, 3, 5]


def wins(n):
    return f"{n}連勝"


def losses(n):
    return f"{n}連敗"


def period_label(n):
    return f"{n}日間"


# --- condition summary families: (type, value) (fixed values) ---
COND_ALL = ("全期間", "全期間")
COND_WEEKDAY = "曜日"
COND_DAY_TYPE = "日種別"
COND_LAST_DIGIT = "下一桁"
COND_REPDIGIT = ("日ゾロ目", "ゾロ目日(11,22)")
COND_MONTH_DAY = ("月日ゾロ", "月日ゾロ")
COND_ANNIVERSARY = ("周年日", "月周年日(20日)")
COND_FIRST_DAY = ("月初", "月初(1日)")
COND_LAST_DAY = ("月末", "月末")

# --- special-day profiles: days of month and month end (fixed values) ---
SPECIAL_PROFILES = {
    "island": {"days": [6, 16, 26], "month_end": True},
    "espas": {"days": [6, 14, 16, 26], "month_end": True},
    "none": {"days": [], "month_end": False},
}

# --- percentile knots P25, P50, P75 (fixed values) ---
WIN_KNOTS = (0.357, 0.429, 0.50)
PAYOUT_KNOTS = (1.0091, 1.0247, 1.0447)

# --- tier rules, first match wins: (category, streak, rank, text) (fixed values) ---
# A category of None means any category; its name then starts the text.
TIER_RULES = [
    (digit_category(0), None, 0, "対象外（避けるべき日）"),
    (digit_category(1), None, 0, "対象外（避けるべき日）"),
    (digit_category(8), losses(3), 5, "8のつく日+3連敗 (108.81%)"),
    (digit_category(8), losses(5), 5, "8のつく日+5連敗 (108.30%)"),
    (CAT_EVENT, losses(5), 5, "LINE告知+5連敗 (108.15%)"),
    (CAT_MONTH_END, losses(3), 4, "月末+3連敗 (107.80%)"),
    (None, wins(5), 4, "{category}+5連勝 (107.24%)"),
    (CAT_EVENT, wins(3), 4, "LINE告知+3連勝 (106.82%)"),
    (CAT_MONTH_END, losses(2), 4, "月末+2連敗 (106.09%)"),
    (CAT_EVENT, losses(3), 3, "LINE告知+3連敗 (106.01%)"),
    (CAT_EVENT, wins(2), 3, "LINE告知+2連勝 (105.45%)"),
    (CAT_EVENT, wins(5), 3, "LINE告知+5連勝 (105.31%)"),
    (CAT_EVENT, None, 2, "LINE告知のみ (103.99%)"),
    (CAT_MONTH_END, None, 2, "月末のみ (103.86%)"),
    (None, wins(3), 1, "3連勝のみ (103.53%)"),
    (None, losses(3), 1, "3連敗のみ (103.68%)"),
]
TIER_DEFAULT = (0, "対象外")

# --- strategy names (fixed values) ---
NO_CONDITION = "条件なし"
NO_CONDITION_AT_ALL = "全条件なし"

# --- score methods (fixed values) ---
SCORE_METHODS = [
    "original",
    "simple",
    "rms_reliability",
    "rms_frequency",
    "strategy_filter",
    "rms_frequency_filter",
    "rms_frequency_anomaly",
    "rms_frequency_dual",
]
FILTERED_METHODS = ["strategy_filter", "rms_frequency_filter"]

# --- back-test selection rules (fixed values) ---
TOP_RULES = [1, 2, 3, 4, 5]
THRESHOLD_RULES = [80, 85, 90, 95, 96, 97, 98, 99]

# --- priority by ratio to the best score (fixed values) ---
PRIORITY_STEPS = [(0.99, 5), (0.97, 4), (0.95, 3), (0.90, 2), (0.80, 1)]

# --- captured page: headers of the unit table (fixed values) ---
PAGE_HEADERS = ["台番", "差枚", "G数", "BB", "RB", "合成"]
AVERAGE_ROW = "平均"

# --- floor grid: keyword -> kind, first keyword wins (fixed values) ---
STRUCTURE_KEYWORDS = [
    ("エスカレーター", "escalator"),
    ("ＥＳ", "escalator"),
    ("ES", "escalator"),
    ("階段", "stairs"),
    ("カウンター", "counter"),
    ("精算機", "counter"),
    ("POS", "counter"),
    ("MC", "counter"),
    ("ロッカー", "locker"),
    ("自販機", "vending"),
    ("柱", "pillar"),
    ("棚", "shelf"),
    ("WC", "restroom"),
    ("トイレ", "restroom"),
    ("入口", "entrance"),
    ("出口", "entrance"),
    ("ATM", "other"),
]

# --- error classes: (class, words in the title, words in the message) (fixed values) ---
ERROR_CLASSES = [
    ("cloudflare", ["cloudflare", "just a moment", "checking"], ["cloudflare"]),
    ("timeout", [], ["timeout", "Timeout", "Navigation timeout"]),
    ("network", [], ["net::", "ECONNREFUSED", "ENOTFOUND", "network"]),
    ("parse", [], ["parse", "undefined", "null", "Cannot read"]),
]

# --- states (fixed values) ---
FAILURE_STATUSES = ["pending", "resolved", "ignored"]
PRIORITY_ORDER = ["high", "normal", "low"]

# --- back-test report grades: (win % above, payout % above, stars, label) (fixed values) ---
GRADES = [
    (60.0, 108.0, 5, "非常に高い"),
    (55.0, 105.0, 4, "高い"),
    (50.0, 102.0, 3, "中程度"),
    (45.0, 100.0, 2, "低い"),
]
GRADE_LOWEST = (1, "非常に低い")

# --- volatility and moving-average labels (fixed values) ---
VOLATILITY_STEPS = [(0.1, "高ボラ（設定変更頻繁）"), (0.05, "中ボラ")]
VOLATILITY_LOW = "低ボラ（設定固定気味）"
GOLDEN_CROSS = "ゴールデンクロス"
