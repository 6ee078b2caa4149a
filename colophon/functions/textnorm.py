"""Text normalisation: Column to Column functions, all built-in expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no meaning in a title, and suffixes in the order in which they are tried.
STOP = (
    "a an the of on in for to and or with without via using by from at as is are be am "
    "towards toward into over under our new we its their it this that these those can "
    "do does more than not no all any some such very much many you we they he she"
).split()
SUFFIXES = ("ations", "ation", "ings", "ing", "edly", "ed", "es", "s")
# Unicode dashes and spaces that printed names use.
DASHES, SPACES = "‐‑‒–—―−﹘﹣－", "    "


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def apart(f, *cols: Column) -> Column:
    """f(*cols), evaluated by itself, once for a row, rather than as part of a stage's generated code.

    Long chains of patterns would make that code too large to compile.
    """
    cells = F.struct(*[c.alias(f"c{k}") for k, c in enumerate(cols)])
    return F.transform(F.array(cells), lambda x: f(*[x[f"c{k}"] for k in range(len(cols))]))[0]


def norm(title: Column) -> Column:
    """FN-01: lower case, braces and backslashes dropped, all else but a-z0-9 one space."""
    plain = F.lower(F.regexp_replace(or_empty(title), r"[{}\\]", ""))
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def words(title: Column) -> Column:
    return F.filter(F.split(norm(title), " "), lambda w: w != "")


def stem(word: Column) -> Column:
    """FN-02: the first suffix of the list that fits goes, if more than three letters remain; each has its own length guard."""
    out = word
    for s in reversed(SUFFIXES):
        fits = word.endswith(s) & (F.length(word) > len(s) + 3)
        out = F.when(fits, F.substr(word, F.lit(1), F.length(word) - len(s))).otherwise(out)
    return out


def tokens(title: Column) -> Column:
    """FN-03: the distinct stems of the words of three letters or more that aren't stop words."""
    kept = F.filter(words(title), lambda w: (F.length(w) > 2) & ~w.isin(*STOP))
    return F.array_distinct(F.transform(kept, stem))


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def containment(a: Column, b: Column) -> Column:
    """FN-04: the share of the smaller set that is in the larger; 0 if one is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(_shared(a, b) / F.least(F.size(a), F.size(b)))


def jaccard(a: Column, b: Column) -> Column:
    """FN-05."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(_shared(a, b) / F.size(F.array_union(a, b)))


def head(title: Column) -> Column:
    """FN-06: what stands before the first colon, if it has 40 characters or fewer."""
    h = norm(F.substring_index(or_empty(title), ":", 1))
    return F.when(F.length(h) <= 40, h).otherwise("")


def surname(name: Column) -> Column:
    """FN-07: the last word of what precedes a comma, or of the name; '' of an empty name."""
    flat = F.trim(F.regexp_replace(or_empty(name), r"[{}\\]", ""))
    part = words(F.substring_index(flat, ",", 1))
    return or_empty(F.try_element_at(part, F.lit(-1)))


def surnames(names: Column) -> Column:
    return F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), surname), lambda s: (F.length(s) > 1) & ~s.isin(*STOP))


def fullnames(names: Column) -> Column:
    """FN-08: each person as the sorted distinct tokens of two letters or more; persons with fewer than two are left out."""

    def one(n: Column) -> Column:
        flat = F.replace(F.regexp_replace(or_empty(n), r"[{}\\]", " "), F.lit(","), F.lit(" "))
        return F.array_sort(F.array_distinct(F.filter(words(flat), lambda t: F.length(t) > 1)))

    people = F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), one), lambda p: F.size(p) >= 2)
    return F.array_distinct(F.transform(people, lambda p: F.array_join(p, " ")))


def split_authors(text: Column) -> Column:
    """FN-09."""
    return F.filter(F.transform(F.split(or_empty(text), r"\s+and\s+"), lambda x: F.trim(x)), lambda x: x != "")


def mention_key(name: Column) -> Column:
    """FN-11: letters and digits alone, without what stands in parentheses."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(or_empty(name))), r"\s*\(.*?\)\s*", " "), "[^a-z0-9]+", "")


def paper_number(text: Column) -> Column:
    """FN-12: the first dddd.dddd or dddd.ddddd, null if there is none."""
    return F.nullif(F.regexp_extract(or_empty(text), r"([0-9]{4}\.[0-9]{4,5})", 1), F.lit(""))


def paper_of_url(url: Column) -> Column:
    """FN-13: the number of an anchored abs/html/pdf address, its version stripped."""
    found = F.regexp_extract(or_empty(url), r"^https://arxiv\.org/(?:html|abs|pdf)/([0-9]{4}\.[0-9]{4,5})(?:v[0-9]+)?(?:\.pdf)?(?:[#?].*)?$", 1)
    return F.nullif(found, F.lit(""))


def clean_model(raw: Column) -> Column:
    """FN-14: dashes and spaces folded; trailing markers, footnotes and remarks dropped."""
    s = F.trim(F.translate(or_empty(raw), DASHES + SPACES, "-" * len(DASHES) + " " * len(SPACES)))
    s = F.regexp_replace(s, r"(?i)\s*\((?:text|speech|t\.?|s\.?|ours|proposed)\)\s*$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"\s*\[[0-9, ]+\]\s*$", ""), r"[†*‡§¶^]+$", ""))


def variants(s: Column) -> Column:
    """FN-15: as written, with separators as hyphens, and without separators."""
    return F.array_distinct(F.array(s, F.regexp_replace(s, r"[\s_]+", "-"), F.regexp_replace(s, r"[\s_-]+", "")))


def slug(s: Column, most: int = 48) -> Column:
    """FN-16."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(or_empty(s)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, most)


#: Latin letters with marks, by Unicode's compatibility decomposition, and their plain letters.
_MARKED = [(c, unicodedata.normalize("NFKD", c)[0]) for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if unicodedata.normalize("NFKD", c)[0].isascii()]


def ascii_fold(s: Column) -> Column:
    """FN-16: marked Latin letters as plain ones, combining marks dropped."""
    folded = F.translate(or_empty(s), "".join(a for a, _ in _MARKED), "".join(b for _, b in _MARKED))
    return F.regexp_replace(folded, r"\p{M}+", "")


def key(s: Column) -> Column:
    """FN-18."""
    return F.regexp_replace(F.lower(or_empty(s)), "[^a-z0-9]", "")


def venue_key(s: Column) -> Column:
    """FN-19: as key, but & stays."""
    return F.regexp_replace(F.lower(or_empty(s)), "[^a-z0-9&]", "")


def year_of(s: Column) -> Column:
    """FN-20: the first year 19xx or 20xx between word bounds, else between digits' bounds; null if there is none."""
    bound = F.nullif(F.regexp_extract(or_empty(s), r"\b((?:19|20)[0-9]{2})\b", 1), F.lit(""))
    return F.coalesce(bound, F.nullif(F.regexp_extract(or_empty(s), r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", 1), F.lit("")))


def html_escape(s: Column) -> Column:
    """FN-31: & first."""
    out = or_empty(s)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def squeeze(s: Column) -> Column:
    """FN-48."""
    return F.trim(F.regexp_replace(or_empty(s), r"\s+", " "))


def shortened(s: Column, most: int) -> Column:
    """SNK-05, FN-57: at most `most` characters, and an ellipsis if some are left out."""
    return F.when(F.length(s) > most, F.concat(F.substring(s, 1, most), F.lit(" …"))).otherwise(s)


def first_filled(*cols: Column) -> Column:
    """FN-58: the first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def number(s: Column) -> Column:
    """FN-46: a double, null of anything that isn't a plain decimal number."""
    return F.when(s.rlike(r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"), s.try_cast("double"))
