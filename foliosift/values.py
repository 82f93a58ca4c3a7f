"""Word lists, enums, patterns and constants that results depend on.

Everything here is data. Functions that use it take it as a default argument, so
a caller can pass another list.
"""

# --- Boilerplate phrases, removed one after the other in this order -------------
BOILERPLATE_PHRASES = (
    "この記事では",
    "結論から言うと",
    "最後までご覧いただきありがとうございます",
    "いかがでしたか",
    "まとめ",
    "以上です",
    "ご覧いただき",
    "ありがとうございました",
)

# --- Annotation tasks: answer fields, allowed answers, failure messages --------
DIFFICULTY_LEVELS = ("very easy", "easy", "medium", "hard", "very hard")
QUALITY_LEVELS = ("very poor", "poor", "average", "good", "excellent")
TASK_TAGS = (
    "Information seeking",
    "Reasoning",
    "Planning",
    "Editing",
    "Coding & Debugging",
    "Math",
    "Role playing",
    "Data analysis",
    "Creative writing",
    "Advice seeking",
    "Brainstorming",
    "Others",
)
FAILURE_MESSAGES = {
    "difficulty": "Failed to get difficulty",
    "quality": "Failed to get quality",
    "classification": "Failed to get classification",
}
SAMPLING_DEFAULTS = {
    "temperature": 0.2,
    "top_p": 0.95,
    "top_k": 64,
    "max_output_tokens": 8192,
}

# --- Item records ------------------------------------------------------------
ITEM_FIELDS = ("id", "name", "value")
FILTER_OPERATORS = ("eq", "ne", "gt", "lt", "gte", "lte", "in", "contains")
SORT_ORDERS = ("asc", "desc")
PROCESSOR_STATUSES = ("success", "error", "pending")

# --- Scores ------------------------------------------------------------------
SCORE_MIN, SCORE_MAX = 0.0, 4.0
SCORE_CLASSES = (0, 1, 2, 3, 4)
EDUCATIONAL_THRESHOLD = 2.5

# --- Function words per language -----------------------------------------------
FUNCTION_WORDS = {
    "de": ("der", "die", "und", "von", "zu", "im", "dem", "nicht", "ist"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "was", "for"),
    "es": ("el", "los", "las", "de", "que", "y", "con", "por", "su"),
    "fr": ("le", "la", "les", "des", "et", "un", "une", "que", "est"),
}
# Kana that carry Japanese grammar (particles and inflection).
JAPANESE_PARTICLE_KANA = "はがをにでとのもへやかたてだなしいるすまられ"

# --- Lexicons: neutral placeholders, meant to be replaced by the user's table ----
LEXICONS = {
    "ads": ("buy now", "click here", "free shipping", "limited offer", "subscribe"),
    "adult": ("explicit content", "adults only", "nsfw"),
    "violence": ("attack", "assault", "weapon", "murder"),
    "discrimination": ("idiot", "moron", "scum", "stupid", "trash", "worthless"),
}

# --- Markup --------------------------------------------------------------------
DROPPED_ELEMENTS = ("script", "style")

# --- Emoji: fixed values, the code points (or first and last) that Unicode calls emoji -----
# Digits, "#" and "*" are left out (they are emoji in keycaps only), as are the letters of flags.
EMOJI_POINTS = (
    "A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0 "
    "25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 "
    "265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE "
    "26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 "
    "271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 "
    "2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A "
    "1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD "
    "1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 "
    "1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 "
    "1F6CB-1F6D2 1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 "
    "1F947-1F9FF 1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8"
).split()
#: Every sequence holds one of these.
EMOJI_SIGNS = (
    r"[\x{A9}\x{AE}\x{203C}-\x{2BFF}\x{3030}\x{303D}\x{3297}\x{3299}\x{FE0F}\x{1F000}-\x{1FAFF}]"
)


def _nested(points: list[str]) -> str:
    """A character class that is searched by halves: Java walks through the ranges of a plain one
    one after the other."""
    if len(points) <= 4:
        return "[" + "".join("-".join(rf"\x{{{p}}}" for p in one.split("-")) for one in points) + "]"
    halves = (points[: len(points) // 2], points[len(points) // 2 :])
    span = [rf"\x{{{half[0].split('-')[0]}}}-\x{{{half[-1].split('-')[-1]}}}" for half in halves]
    return "[" + "".join(f"[{ends}&&{_nested(half)}]" for ends, half in zip(span, halves)) + "]"


_BASE = _nested(EMOJI_POINTS)
# A base with its variation or skin tone and tags; such elements joined; flags; marks left over.
_ELEMENT = _BASE + r"(?:[\x{FE0E}\x{FE0F}]|[\x{1F3FB}-\x{1F3FF}])?(?:[\x{E0020}-\x{E007E}]+\x{E007F}?)?"
EMOJI = "|".join(
    (
        rf"{_ELEMENT}(?:\x{{200D}}+{_ELEMENT})*\x{{200D}}?",
        r"[\x{1F1E6}-\x{1F1FF}]{2}",
        r"[\x{FE0F}\x{20E3}]",
    )
)

#: A keycap with its digit or sign.
KEYCAP = r"[0-9#*]\x{FE0F}?\x{20E3}"

# --- MinHash: h(x) = (a * x + b) mod p, one pair per permutation -------------------
MINHASH_PRIME = 2**31 - 1
MINHASH_COEFFICIENTS = (
    (288545019, 1222356005),
    (1819850096, 1722851096),
    (1640193507, 135520872),
    (547756575, 253228484),
    (1063938750, 1634154402),
    (965274706, 1014138928),
    (1399285262, 815217483),
    (1693770508, 450874518),
    (201561927, 1047664193),
    (60875733, 1918383731),
    (1794791898, 837108038),
    (929360196, 1304463163),
    (1636984003, 1647458476),
    (4522708, 1494289708),
    (956461719, 571940513),
    (1549495424, 1721909018),
    (491263129, 1269492320),
    (2029953362, 219531151),
    (1935800733, 681674953),
    (65691503, 47936369),
    (54644573, 1394889710),
    (1162674448, 19767455),
    (2016807462, 1892435308),
    (818629864, 1474212860),
    (465143664, 2080998945),
    (906488443, 1558756592),
    (62364612, 1133075550),
    (476079231, 1640035399),
    (940356433, 2016845815),
    (1064748683, 1187256901),
    (500545053, 742385984),
    (495782128, 1453521182),
)
MINHASH_BANDS = 8
SHINGLE_WORDS = 5
