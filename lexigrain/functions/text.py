"""Text, reading and key columns. Everything but ``nfkc`` stays inside the JVM."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Character classes, junk words and sound-change tables.
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
JUNK_WORDS = ("missing", "???")
KANA_RANGES = ((0x3040, 0x309F), (0x30A0, 0x30FF))
HAN_RANGES = (
    (0x2E80, 0x2EFF), (0x2F00, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029),
    (0x3038, 0x303B), (0x31C0, 0x31EF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF), (0x16FE2, 0x16FE3), (0x16FF0, 0x16FF1),
    (0x20000, 0x2EE5F), (0x2F800, 0x2FA1F), (0x30000, 0x3347F),
)
REPEAT_MARK = "々"
PLAIN_FIRST = "かきくけこさしすせそたちつてとはひふへほ"
VOICED_FIRST = "がぎぐげござじずぜぞだぢづでどばびぶべぼ"
H_FIRST = "はひふへほ"
P_FIRST = "ぱぴぷぺぽ"
GEMINATING_LAST = "くきちつ"
GEMINATE = "っ"
RUBY_SEGMENT = r"[^\[\]]+(?:\[[^\[\]]*\])?"

# U+30A1..U+30F6 have hiragana counterparts 0x60 below.
KATAKANA = "".join(map(chr, range(0x30A1, 0x30F7)))
HIRAGANA = "".join(map(chr, range(0x3041, 0x3097)))

_JUNK = r"(?is)\A(?:" + "|".join(map(re.escape, JUNK_WORDS)) + r"|.*[<>].*)\z"
# What an array's elements hold, joined by \x00, if cleaning changes one: white space, markup, a junk word, nothing.
_MAY_CHANGE = rf"(?i)[{SPACE_CLASS}<>]|" + "|".join(map(re.escape, JUNK_WORDS)) + r"|\A\x00|\x00\x00|\x00\z|\A\z"

# Possessive quantifiers: a malformed string fails in linear time.
_RUBY_VALID = rf"(?s)\A(?=.*[^{SPACE_CLASS}])" + r"(?:[^\[\]]++(?:\[[^\[\]]*+\])?+)++\z"
# Characters NFKC leaves alone, none of them combining.
_NFKC_STABLE = (
    r"\A[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    r"\u3041-\u3096\u30a1-\u30fa\u30fc\u4e00-\u9fff]*\z"
)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def kana_fold(c) -> Column:
    """Katakana to hiragana; every other character stays."""
    return F.translate(as_col(c), KATAKANA, HIRAGANA)


def strip(c) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(as_col(c), F.lit(SPACES))


def reading_stem(c) -> Column:
    """Bare reading: stripped, no affix marks, cut at the inflection dot, folded."""
    bare = F.replace(strip(F.coalesce(as_col(c), F.lit(""))), F.lit("-"), F.lit(""))
    return kana_fold(F.substring_index(bare, ".", 1))


def reading_class(reading, on, kun) -> Column:
    """``On``, ``Kun`` or ``Other``; ``On`` wins when both lists hold the stem."""
    stem = reading_stem(reading)

    def listed(xs):
        return (stem != "") & F.coalesce(F.exists(as_col(xs), lambda x: reading_stem(x) == stem), F.lit(False))

    return F.when(listed(on), "On").when(listed(kun), "Kun").otherwise("Other")


def clean_text(c) -> Column:
    """Collapsed display text, or NULL for blanks, junk words and leaked markup."""
    text = F.trim(F.regexp_replace(as_col(c), f"[{SPACE_CLASS}]+", " "))
    return F.nullif(F.regexp_replace(text, _JUNK, ""), F.lit(""))


def clean_array(xs) -> Column:
    """Clean every element, drop junk, keep the first of equal ones in order.

    All elements are looked through at once; they are cleaned one by one only where one of them may change.
    """
    xs = as_col(xs)
    changes = F.array_join(xs, "\x00").rlike(_MAY_CHANGE)
    cleaned = F.when(changes, F.transform(xs, clean_text)).otherwise(xs)
    kept = F.array_distinct(F.array_compact(cleaned))
    return F.coalesce(kept, F.array().cast("array<string>"))


def ruby_segments(c) -> Column:
    """``base[reading]base`` as an array of (base, reading); NULL when malformed."""
    c = as_col(c)


    def pair(segment):
        bracket = F.substring_index(segment, "[", -1)
        reading = F.when(F.endswith(segment, F.lit("]")), F.rtrim(bracket, F.lit("]"))).otherwise("")
        return F.struct(F.substring_index(segment, "[", 1).alias("base"), reading.alias("reading"))

    segments = F.regexp_extract_all(c, F.lit(RUBY_SEGMENT), F.lit(0))
    return F.when(c.rlike(_RUBY_VALID), F.transform(segments, pair))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


# Not pushed below filters, which would run it once for the filter and once more.
_nfkc = _nfkc.asNondeterministic()


def nfkc(c) -> Column:
    """Compatibility normalization; only strings that can change reach Python."""
    c = as_col(c)
    return F.coalesce(_nfkc(F.when(~c.rlike(_NFKC_STABLE), c)), c)


def nfkc_fold(c) -> Column:
    """Normalize, strip and fold without cutting inflections."""
    return kana_fold(strip(nfkc(F.coalesce(as_col(c), F.lit("")))))


def nfkc_each(xs) -> Column:
    """Normalize every array element in one call.

    The elements travel joined by a unit separator, which normalization neither
    changes nor composes across.
    """
    sep = "\x1f"
    bare = F.transform(as_col(xs), lambda x: F.translate(x, sep, ""))
    joined = F.when(F.size(bare) > 0, F.array_join(bare, sep))
    return F.coalesce(F.split(nfkc(joined), sep), F.array().cast("array<string>"))


def _in_ranges(c, ranges) -> Column:
    point = F.ascii(as_col(c))
    test = F.lit(False)
    for low, high in ranges:
        test = test | point.between(low, high)
    return test


def is_kana(c) -> Column:
    return _in_ranges(c, KANA_RANGES)


def is_han(c) -> Column:
    # U+3006 is inside the first iteration-mark range.
    return _in_ranges(c, HAN_RANGES)


def _class_of(ranges) -> str:
    return "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in ranges)


HAN_CLASS = _class_of(HAN_RANGES)


def _count_in(c, ranges) -> Column:
    return F.regexp_count(as_col(c), F.lit(f"[{_class_of(ranges)}]"))


def kana_count(c) -> Column:
    """Number of kana in a text."""
    return _count_in(c, KANA_RANGES)


def han_count(c) -> Column:
    """Number of Han characters in a text."""
    return _count_in(c, HAN_RANGES)


def level_label(c) -> Column:
    c = as_col(c)
    return F.when(c.between(1, 5), F.concat(F.lit("N"), c.cast("int").cast("string")))


def from_code_point(n) -> Column:
    """The character of an integer code point, on any plane."""
    return F.decode(F.unhex(F.lpad(F.hex(as_col(n).cast("bigint")), 8, "0")), "UTF-32")


def code_point_hex(ch) -> Column:
    """Five or more lower-case hex digits of a character's code point."""
    digits = F.lower(F.hex(F.ascii(as_col(ch))))
    return F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)


def asset_path(ch, folder: str, suffix: str) -> Column:
    return F.concat(F.lit(f"{folder}/"), code_point_hex(ch), F.lit(f".{suffix}"))


def key_file_name(key, suffix: str) -> Column:
    """``_``-joined hex code points, safe for any key length."""
    points = F.transform(F.split(as_col(key), ""), lambda ch: F.lower(F.hex(F.ascii(ch))))
    return F.concat(F.array_join(points, "_"), F.lit(f".{suffix}"))


def query_link(surface) -> Column:
    """``?query=`` and the percent-encoded surface; only ``A-Za-z0-9_.-~`` stay plain."""
    quoted = F.url_encode(as_col(surface))
    quoted = F.regexp_replace(quoted, r"\+", "%20")
    quoted = F.regexp_replace(quoted, r"\*", "%2A")
    return F.concat(F.lit("?query="), F.regexp_replace(quoted, "%7E", "~"))


def date_to_revision(c) -> Column:
    return F.translate(as_col(c), "-", ".")
