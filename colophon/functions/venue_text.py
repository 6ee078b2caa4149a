"""Venue names and evidence: tidying, families, provenance buckets, acceptance phrases, page checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colophon.functions import textnorm as T
from colophon.functions.rules import first_rule

# Patterns of venue families, in the order in which they are tried.
FAMILIES = (
    ("interspeech", "interspeech"), ("icassp|acoustics.{0,20}speech.{0,20}signal", "icassp"), (r"\basru\b|automatic speech recognition and understanding", "asru"),
    (r"\bslt\b|spoken language technology", "slt"), ("odyssey", "odyssey"), ("waspaa", "waspaa"), ("taslp|transactions on audio", "taslp"),
    ("iscslp|chinese spoken language", "iscslp"), ("apsipa", "apsipa"), (r"speech synthesis workshop|\bssw\b", "ssw"),
    (r"\bacl\b|annual meeting of the association for computational linguistics", "acl"), ("emnlp|empirical methods in natural language", "emnlp"),
    ("naacl|nations of the americas chapter|north american chapter", "naacl"), (r"\beacl\b|european chapter of the association", "eacl"),
    (r"\baacl\b|ijcnlp|asia-pacific chapter", "aacl"), ("coling|international conference on computational linguistics", "coling"),
    (r"\blrec\b|language resources and evaluation", "lrec"), ("conll", "conll"), (r"\btacl\b|transactions of the association for computational linguistics", "tacl"),
    (r"neurips|\bnips\b|neural information processing systems", "neurips"), (r"\biclr\b|learning representations", "iclr"),
    (r"\bicml\b|international conference on machine learning", "icml"), (r"\baaai\b", "aaai"), ("ijcai", "ijcai"),
    (r"\bcolm\b|conference on language modeling", "colm"), (r"\btmlr\b|transactions on machine learning research", "tmlr"), (r"\bjmlr\b", "jmlr"),
    (r"\bkdd\b|knowledge discovery and data mining", "kdd"), ("sigir", "sigir"), (r"\bcvpr\b|computer vision and pattern recognition", "cvpr"),
    (r"\biccv\b", "iccv"), (r"\beccv\b", "eccv"), (r"\bwacv\b", "wacv"), (r"\bicme\b|multimedia and expo", "icme"),
    (r"acm mm|acm multimedia|international conference on multimedia\s*\(|\bmm '?\d\d", "acmmm"), ("ismir|music information retrieval", "ismir"),
    ("dcase", "dcase"), ("symposium on security and privacy", "sp"), ("computer speech", "csl"), ("speech communication", "speechcom"),
)
# Evidence hosts and words, in order, and the names of sources.
HOSTS = (
    ("aclanthology.org", "acl_anthology"), ("isca-archive.org", "isca_archive"), ("isca-speech.org", "isca_archive"), ("openreview.net", "openreview"),
    ("ieeexplore.ieee.org", "ieee"), ("ieee.org", "ieee"), ("dl.acm.org", "acm"), ("acm.org", "acm"), ("dblp.org", "dblp"), ("dblp.uni-trier.de", "dblp"),
    ("doi.org", "publisher"), ("crossref.org", "publisher"), ("link.springer.com", "publisher"), ("sciencedirect.com", "publisher"),
    ("direct.mit.edu", "publisher"), ("mitpressjournals.org", "publisher"), ("proceedings.mlr.press", "publisher"), ("mlr.press", "publisher"),
    ("papers.nips.cc", "publisher"), ("neurips.cc", "publisher"), ("proceedings.neurips.cc", "publisher"), ("ojs.aaai.org", "publisher"), ("aaai.org", "publisher"),
    ("ijcai.org", "publisher"), ("ismir.net", "publisher"), ("thecvf.com", "publisher"), ("jmlr.org", "publisher"), ("arxiv.org", "arxiv"),
)
NEEDLES = (
    ("anthology", "acl_anthology"), ("isca", "isca_archive"), ("openreview", "openreview"), ("journal_ref", "arxiv_journal_ref"),
    ("journal reference", "arxiv_journal_ref"), ("arxiv", "arxiv_comment"), ("ieee", "ieee"), ("acm", "acm"), ("dblp", "dblp"),
    ("crossref", "publisher"), ("doi", "publisher"), ("proceedings", "publisher"),
)
SOURCES = "acl_anthology isca_archive openreview ieee acm dblp publisher arxiv_comment arxiv_journal_ref arxiv other".split()
#: Names that are too common to be evidence.
GENERIC = "bench benchmark eval evaluation test suite audio speech voice sound music model models data dataset corpus task tasks core hear sonar oasis atlas amuse debate mae compa echo probe".split()
# Phrases of acceptance with what they name, and venues named with their year.
_ACCEPTED = r"(?i)\b(?:Accepted (?:to|at|by)|To appear (?:in|at)|Published (?:in|at)|Camera[- ]ready for)\s+([^.;]{3,70})"
_NAMED = r"\b((?:ICASSP|INTERSPEECH|Interspeech|ACL|EMNLP|NAACL|NeurIPS|ICLR|ICML|SLT|ASRU|AAAI|IJCAI|COLING|TMLR|ISMIR|WASPAA|EUSIPCO|ICME|MM)\s*'?\s*20\d\d)"


def tidy(name: Column) -> Column:
    """FN-21: a venue's name without years, ordinals and parenthesised editions; the name itself if nothing is left."""

    def plain(whole: Column) -> Column:
        n = whole
        for pattern, put in ((r"^\s*(?:19|20)\d{2}\s+", ""), (r"\s*(?:19|20)\d{2}\s*$", ""), (r"([A-Za-z])(?:19|20)\d{2}$", "$1"), (r"^\s*\d+(?:st|nd|rd|th)\s+", ""), (r"\s*\([^()]*'?\d{2,4}\)\s*$", ""), (r"\s*(?:19|20)\d{2}\s*$", ""), (r"^[ \-:,]+|[ \-:,]+$", "")):
            n = F.regexp_replace(n, pattern, put)
        return F.coalesce(F.nullif(n, F.lit("")), whole)

    return T.apart(plain, F.trim(T.or_empty(name)))


def display(name: Column, year: Column, track: Column) -> Column:
    """FN-21: name, year and track, those that there are."""
    return F.concat_ws(" ", F.nullif(tidy(name), F.lit("")), F.nullif(T.or_empty(year), F.lit("")), F.nullif(T.or_empty(track), F.lit("")))


def venue_from(journal_ref: Column, comment: Column) -> Column:
    """FN-22: the journal reference, else an acceptance phrase's object, else a named venue with its year; null of none."""
    said = F.regexp_replace(F.trim(F.regexp_extract(T.or_empty(comment), _ACCEPTED, 1)), ",+$", "")
    named = F.regexp_extract(T.or_empty(comment), _NAMED, 1)
    return F.coalesce(F.nullif(F.substring(F.trim(T.or_empty(journal_ref)), 1, 90), F.lit("")), F.nullif(said, F.lit("")), F.nullif(named, F.lit("")))


def family(s: Column) -> Column:
    """FN-23: the first family whose pattern fits; null of none. Evaluate it on distinct strings."""
    return first_rule(FAMILIES, F.concat(F.lit(" "), F.lower(T.or_empty(s)), F.lit(" ")))


def evidence_bucket(url: Column, text: Column) -> Column:
    """FN-24: a named source as it is; else by the address's host; else by words of the text."""
    u, t = F.lower(T.or_empty(url)), F.lower(T.or_empty(text))
    arxiv = F.when(t.contains("journal"), "arxiv_journal_ref").otherwise("arxiv_comment")
    out = F.lit("other")
    for needle, tag in reversed(NEEDLES):
        out = F.when(F.contains(t, F.lit(needle)), F.lit(tag)).otherwise(out)
    for host, tag in reversed(HOSTS):
        out = F.when(F.contains(u, F.lit(host)), arxiv if tag == "arxiv" else F.lit(tag)).otherwise(out)
    plain = F.trim(T.or_empty(text))
    return F.when(plain.isin(*SOURCES), plain).otherwise(out)


def search_score(name: Column, want: Column, title: Column, got: Column) -> Column:
    """FN-35: of token sets the larger of jaccard and 0.92 of coverage, 0.78 at least if the title has the name verbatim."""
    shared = F.size(F.array_intersect(want, got))
    base = F.when((F.size(want) == 0) | (F.size(got) == 0), 0.0).otherwise(F.greatest(T.jaccard(want, got), 0.92 * shared / F.size(want)))
    quoted = F.regexp_replace(F.lower(F.trim(name)), r"([^a-z0-9\s])", r"\\$1")
    verbatim = (F.trim(name) != "") & F.regexp_like(F.lower(title), F.concat(F.lit("(?<![a-z0-9])"), quoted, F.lit("(?![a-z0-9])")))
    return F.when(verbatim & (base > 0), F.greatest(base, F.lit(0.78))).otherwise(base)


def title_overlap(a: Column, b: Column) -> Column:
    """FN-36: the share of the shorter title's words (three letters or more) that the other has."""
    w = lambda t: F.array_distinct(F.filter(T.words(t), lambda x: F.length(x) > 2))
    return T.containment(w(a), w(b))


def page_hit(title: Column, page_title: Column, page: Column) -> Column:
    """FN-36: 1 if the page has the title; else the larger of the titles' overlap and the share of its words on the page."""
    w = F.array_distinct(F.filter(T.words(title), lambda x: F.length(x) > 2))
    flat = T.norm(page)
    there = F.filter(w, lambda x: F.contains(flat, x))
    share = F.when(F.size(w) == 0, 0.0).otherwise(F.size(there) / F.size(w))
    return F.greatest(F.when((T.norm(title) != "") & F.contains(flat, T.norm(title)), 1.0).otherwise(0.0), title_overlap(title, page_title), share)


def distinctive(name: Column) -> Column:
    """FN-37: long enough, and not a common word."""
    return (F.length(F.trim(name)) >= 4) & ~F.lower(F.trim(name)).isin(*GENERIC)


def quote_of(name: Column, page: Column, around: int = 90) -> Column:
    """FN-38: the first place of a page that has the name (a hyphen may be a space or nothing), with what stands around it; '' of none.

    The page is split at the first name, and the quote is taken from a window around it: a pattern that begins with what stands
    before would try that much at every place of the page.
    """
    quoted = F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"([^a-z0-9\s\-])", r"\\$1"), "-", "[- ]?")
    pattern = F.concat(F.lit(f"(?i)(.{{0,{around}}}(?<![a-z0-9])(?:"), quoted, F.lit(f")(?![a-z0-9]).{{0,{around}}})"))
    first = F.concat(F.lit("(?i)(?<![a-z0-9])(?:"), quoted, F.lit(")(?![a-z0-9])"))

    def quote(flat: Column, parts: Column) -> Column:
        before = parts[0]
        # a dot stops at line ends that squeeze leaves, so what is before one can't belong to the quote
        near = F.regexp_replace(F.right(before, F.lit(around)), r"(?s)^.*[\n\r\u0085\u2028\u2029]", "")
        behind = F.substr(flat, F.length(before) + 1, F.length(name) + 2 * around + 1)
        return F.when(F.size(parts) < 2, "").otherwise(F.call_function("regexp_extract", F.concat(near, behind), pattern, F.lit(1)))

    flat = T.squeeze(page)
    cells = F.transform(F.array(flat), lambda x: F.struct(x.alias("flat"), F.split(x, first, 2).alias("parts")))
    return F.transform(cells, lambda c: quote(c["flat"], c["parts"]))[0]
