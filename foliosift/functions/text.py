"""Text clean-up as Column -> Column functions."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliosift import values

# Blocks in which every character is its own NFKC form and never combines with a
# neighbour: a text made only of these cannot change under NFKC. The frequent blocks
# come first, because the regex tests the groups one after the other.
NFKC_STABLE_RANGES = (
    ((0x0000, 0x009F),),  # ASCII and C1 controls
    (
        (0x3041, 0x3096),  # hiragana
        (0x30A0, 0x30FE),  # katakana
        (0x4E00, 0x9FFF),  # unified ideographs
        (0x3001, 0x3029),  # CJK punctuation
    ),
    ((0x00BF, 0x0131),),  # Latin letters up to dotless i
    (
        (0x00A1, 0x00A7),
        (0x00AB, 0x00AE),
        (0x00B0, 0x00B1),
        (0x00B6, 0x00B7),
        (0x00BB, 0x00BB),
        (0x0141, 0x0148),
        (0x014A, 0x017E),
        (0x0410, 0x044F),  # Cyrillic
        (0x2010, 0x2010),
        (0x2012, 0x2016),
        (0x2018, 0x2023),
        (0xAC00, 0xD7A3),  # Hangul syllables
    ),
)


def _outside(ranges) -> str:
    return "[^" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]"


_UNSTABLE = "[" + "&&".join(_outside(group) for group in NFKC_STABLE_RANGES) + "]"
# Full-width forms and the ideographic space, mapped one to one by NFKC.
_FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_HALF_WIDTH = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "


def decode_entities(col: Column, no_break_space: str = " ") -> Column:
    """Character references as characters, in one pass: all names of HTML 5, with a semicolon or,
    for those that may lack it, as the longest name that the text begins with; numbers with or
    without a semicolon, those of the C1 block read as Windows-1252.

    A no-break space becomes ``no_break_space``. What is no reference, or names no character, stays.
    """

    def decoded(part: Column, place: Column) -> Column:
        number = F.regexp_extract(F.substring(part, 1, 40), r"^#(?:[0-9]{1,32}|[xX][0-9A-Fa-f]{1,32});?", 0)
        digits = F.regexp_replace(number, "^#[xX]?0*|;$", "")
        value = F.when(F.length(digits).between(1, 7), _number(number, digits))
        code = F.coalesce(F.get(_windows_1252(), value - 0x80), value)
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numbered = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")
        full = F.regexp_extract(F.substring(part, 1, 40), "^[A-Za-z][A-Za-z0-9]{1,31};", 0)
        # The names by their first letter: a map is searched from its beginning.
        named = F.try_element_at(F.get(_names(), F.ascii(full)), full)
        prefix = F.regexp_extract(F.substring(part, 1, 10), _BARE_NAME, 0)
        bare = F.try_element_at(F.get(_names(), F.ascii(prefix)), prefix)
        taken = F.when(number != "", number).when(named.isNotNull(), full).otherwise(prefix)
        char = F.when(number != "", numbered).otherwise(F.coalesce(named, bare))
        char = F.when(char == "\u00a0", F.lit(no_break_space)).otherwise(char)
        rest = F.substring(part, F.length(taken) + 1, F.length(part))
        return F.when(place == 0, part).otherwise(F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), part)))

    return F.array_join(F.transform(F.split(col, "&"), decoded), "")


def _number(reference: Column, digits: Column) -> Column:
    hexadecimal = reference.rlike("^#[xX]")
    return F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("int")


_BARE_NAME = "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"


def _names() -> Column:
    """By the code of the first letter, the map of names to characters; one literal in the plan."""
    by_letter: list[dict[str, str]] = [{} for _ in range(128)]
    for name, char in sorted(html5.items()):
        by_letter[ord(name[0])][name] = char
    return F.from_json(F.lit(json.dumps(by_letter)), "array<map<string,string>>")


def _windows_1252() -> Column:
    """The characters of the bytes from 0x80 on; null where the code page has none."""
    read = [bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)]
    return F.from_json(F.lit(json.dumps([ord(c) if c else None for c in read])), "array<int>")


# A tag from behind its name's first letter to its end: the rest of the name, then white space
# and slashes, or attributes with a quoted, a bare or no value. Every part is possessive, so the
# scan is linear; a tag or quote without an end runs to the end of the text.
_TAG_REST = (
    r"[^\s/>]*+(?:[\s/]++|[^\s/>][^\s/>=]*+"
    r"(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z)|(?![\"'])[^\s>]++)?+)?+)*+(?:>|\z)"
)


def _markup(drop: Sequence[str]) -> str:
    """What the states of a tokenizer take from the text: comments, dropped elements up to their
    own end tag, elements whose content is text (their group 2), tags, other declarations."""
    names = "|".join(re.escape(name) for name in drop) or r"(?!)"
    parts = (
        r"<!--(?:-?>|.*?(?:--!?>|\z))",
        rf"<({names})(?=[\s/>]){_TAG_REST}(?:.*?</\1(?=[\s/>])[^>]*+(?:>|\z)|.*)",
        rf"<(?:title|textarea)(?=[\s/>]){_TAG_REST}(.*?)(?:</(?:title|textarea)(?=[\s/>])[^>]*+(?:>|\z)|\z)",
        rf"</?[a-z]{_TAG_REST}",
        r"<[!?][^>]*+(?:>|\z)",
        r"</(?:>|[^a-z>][^>]*+(?:>|\z))",
    )
    # Every part begins with "<": other places are passed over by that alone.
    return "(?is)(?=<)(?:" + "|".join(parts) + ")"


def strip_html(col: Column, drop: Sequence[str] = values.DROPPED_ELEMENTS) -> Column:
    """Drop tags, comments and ``drop`` elements, decode references, squeeze blanks.

    One expression reads the text as a tokenizer does: a quoted attribute may hold ``>``, a
    comment may hold tags, and the title, whose text stays, is no markup. A dropped element,
    comment or tag without an end runs to the end of the text, as in a browser. A tag starts
    with a letter: prose such as "a < b" stays. Text without any markup character only has its
    blanks squeezed.
    """
    text = F.regexp_replace(col, _markup(drop), " $2 ")
    bare = (
        F.when(F.contains(col, F.lit("&")), decode_entities(text))
        .when(F.contains(col, F.lit("<")), text)
        .otherwise(col)
    )
    return F.trim(F.regexp_replace(bare, r"[ \t]+", " "))


# Stands between text nodes; no character of any text.
_BORDER = "\ufdd0"


def strip_html_parsed(col: Column, drop: Sequence[str] = ("script", "style")) -> Column:
    """The text nodes as an HTML parser gives them, each stripped, joined by one space.

    No-break spaces inside a node stay.
    """
    marked = F.regexp_replace(col, _markup(drop), f"{_BORDER}$2{_BORDER}")
    white = r"^[\s\x{85}\x{A0}\x{1C}-\x{1F}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
    ends = white + "|" + white[1:] + "$"
    nodes = F.transform(F.split(marked, _BORDER), lambda n: F.regexp_replace(decode_entities(n, "\u00a0"), ends, ""))
    return F.array_join(F.filter(nodes, lambda n: n != ""), " ")


def remove_phrases(col: Column, phrases: Sequence[str] = values.BOILERPLATE_PHRASES) -> Column:
    """Remove every occurrence of each phrase, one phrase after the other."""
    return reduce(lambda text, phrase: F.replace(text, F.lit(phrase), F.lit("")), phrases, col)


def strip_emojis(col: Column, keycaps: bool = False) -> Column:
    """Remove emoji as whole sequences: bases with variations, skin tones and tags, joined ones,
    and flags.

    Of a keycap the marks go and the digit stays; with ``keycaps`` it goes too. Plain symbols such
    as a check mark stay, and so do joiners away from emoji, which Indic scripts need.
    """
    pattern = f"{values.KEYCAP}|{values.EMOJI}" if keycaps else values.EMOJI
    # Few texts hold a character that could begin or end a sequence; the rest is not searched.
    return F.when(col.rlike(values.EMOJI_SIGNS), F.regexp_replace(col, pattern, "")).otherwise(col)


def map_full_width(col: Column) -> Column:
    """Full-width forms and the ideographic space as ASCII, a part of NFKC done in the JVM."""
    return F.when(
        col.rlike(r"[\x{FF01}-\x{FF5E}\x{3000}]"), F.translate(col, _FULL_WIDTH, _HALF_WIDTH)
    ).otherwise(col)


def normalize_nfkc(col: Column) -> Column:
    """Unicode NFKC, by the ICU library that Spark carries, so in the JVM.

    Only text that holds a character outside the stable blocks is normalised.
    """
    normal = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), col, F.lit(True))
    return F.when(col.rlike(_UNSTABLE), normal).otherwise(col)


def truncate_tokens(col: Column, max_tokens: int = 512) -> Column:
    """The first ``max_tokens`` whitespace tokens, joined by one space."""
    tokens = F.split(F.regexp_replace(col, r"^\s+|\s+$", ""), r"\s+", max_tokens + 1)
    return F.concat_ws(" ", F.slice(tokens, 1, max_tokens))


def preview(col: Column, length: int = 100) -> Column:
    """The first ``length`` characters and an ellipsis."""
    return F.concat(F.left(col, F.lit(length)), F.lit("..."))
