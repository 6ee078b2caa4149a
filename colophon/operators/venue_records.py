"""Venue records from eight sources (FN-51): ordered rules that name a venue, where a phrase stands in a claim, tracks and workshops.

A rule table gives id, short name and kind at once, as one struct, so that a string is searched once for all three.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import textnorm as T
from colophon.functions import venue_text as V
from colophon.operators.evidence import PUBLISHED_TYPES, openreview_rank, preferred
from colophon.sources.tables import many

# Patterns of book titles, journals, containers and venue groups, in the order in which they are tried, with id,
# short name and (for containers) kind; a Findings volume names its family itself.
FINDINGS = r"^Findings of the Association for Computational Linguistics:?\s*(ACL|EMNLP|NAACL|EACL|IJCNLP|AACL)"
FINDINGS_OF = (("ACL", "acl", "ACL"), ("EMNLP", "emnlp", "EMNLP"), ("NAACL", "naacl", "NAACL"), ("EACL", "eacl", "EACL"), ("IJCNLP", "aacl", "AACL-IJCNLP"), ("AACL", "aacl", "AACL-IJCNLP"))
BOOKS = (
    ("Annual Meeting of the Association for Computational Linguistics", "acl", "ACL"),
    ("Conference on Empirical Methods in Natural Language Processing", "emnlp", "EMNLP"),
    ("Conference of the Nations of the Americas Chapter of the Association for Computational Linguistics", "naacl", "NAACL"),
    ("North American Chapter of the Association for Computational Linguistics", "naacl", "NAACL"),
    ("Conference of the European Chapter of the Association for Computational Linguistics", "eacl", "EACL"),
    ("Asia-Pacific Chapter of the Association for Computational Linguistics", "aacl", "AACL-IJCNLP"),
    ("International Joint Conference on Natural Language Processing", "aacl", "AACL-IJCNLP"),
    ("International Conference on Computational Linguistics", "coling", "COLING"),
    ("Language Resources and Evaluation Conference", "lrec", "LREC"),
    ("Conference on Computational Natural Language Learning", "conll", "CoNLL"),
)
JOURNALS = (("Transactions of the Association for Computational Linguistics", "tacl", "TACL"), ("^Computational Linguistics$", "cl", "Computational Linguistics"))
CONTAINERS = (
    (r"\bICASSP\b|Acoustics,? Speech,? and Signal Processing", "icassp", "ICASSP", "conference"),
    (r"Spoken Language Technology Workshop|\bSLT\b", "slt", "SLT", "conference"),
    (r"Automatic Speech Recognition and Understanding|\bASRU\b", "asru", "ASRU", "conference"),
    ("Applications of Signal Processing to Audio and Acoustics|WASPAA", "waspaa", "WASPAA", "conference"),
    (r"Multimedia and Expo|\bICME\b", "icme", "ICME", "conference"),
    (r"International Conference on Multimedia\b|Multimedia \(MM|\bACM Multimedia\b", "acmmm", "ACM MM", "conference"),
    ("Computer Vision and Pattern Recognition", "cvpr", "CVPR", "conference"),
    ("International Conference on Computer Vision", "iccv", "ICCV", "conference"),
    ("European Conference on Computer Vision", "eccv", "ECCV", "conference"),
    ("Knowledge Discovery and Data Mining", "kdd", "KDD", "conference"),
    ("Research and Development in Information Retrieval", "sigir", "SIGIR", "conference"),
    ("Human Factors in Computing Systems", "chi", "CHI", "conference"),
    ("AAAI Conference on Artificial Intelligence|Proceedings of the AAAI", "aaai", "AAAI", "conference"),
    ("International Joint Conference on Artificial Intelligence", "ijcai", "IJCAI", "conference"),
    ("Transactions of the Association for Computational Linguistics", "tacl", "TACL", "journal"),
    ("IEEE/ACM Transactions on Audio, Speech,? and Language Processing|IEEE Transactions on Audio, Speech,? and Language Processing", "taslp", "IEEE/ACM TASLP", "journal"),
    ("Computer Speech (and|&amp;|&) Language", "csl", "Computer Speech & Language", "journal"),
    ("^Speech Communication$", "speechcom", "Speech Communication", "journal"),
    ("Chinese Spoken Language Processing|ISCSLP", "iscslp", "ISCSLP", "conference"),
    ("APSIPA", "apsipa", "APSIPA ASC", "conference"),
    ("Interspeech", "interspeech", "Interspeech", "conference"),
    ("Music Information Retrieval", "ismir", "ISMIR", "conference"),
    ("Advances in Neural Information Processing Systems|Neural Information Processing Systems", "neurips", "NeurIPS", "conference"),
    ("International Conference on Learning Representations", "iclr", "ICLR", "conference"),
    ("International Conference on Machine Learning", "icml", "ICML", "conference"),
    ("Conference on Language Modeling", "colm", "COLM", "conference"),
    ("Symposium on Security and Privacy", "ieee-sp", "IEEE S&P", "conference"),
    ("IEEE Transactions on Artificial Intelligence", "ieee-tai", "IEEE TAI", "journal"),
    ("COMmunication Systems and NETworks|COMSNETS", "comsnets", "COMSNETS", "conference"),
)
GROUPS = ((r"^ICLR\.cc", "iclr", "ICLR"), (r"^NeurIPS\.cc", "neurips", "NeurIPS"), (r"^ICML\.cc", "icml", "ICML"), ("^TMLR", "tmlr", "TMLR"), (r"^colmweb\.org", "colm", "COLM"), (r"^aclweb\.org", "acl", "ACL"), (r"^AAAI\.org", "aaai", "AAAI"))
# Tracks in parentheses of a book title; venues that a comment or an index names by their short name; tracks that
# a comment claims, with how they are shown; phrases of acceptance and of submission; a workshop with its topic and short name.
BOOK_TRACK = r"(?i)\((Volume \d+: [^)]+|System Demonstrations|Industry Track|Student Research Workshop|Tutorial Abstracts|Demonstrations?)\)"
SAID = r"(?i)\b(ACL|EMNLP|NAACL|EACL|COLING|LREC|CoNLL|NeurIPS|NIPS|ICLR|ICML|AAAI|IJCAI|COLM|TMLR|Interspeech|ICASSP|ASRU|SLT|Odyssey|WASPAA|ISMIR|CVPR|ICCV|ECCV|ACM MM|ICME|TACL)\b"
INDEXED = "(?i)^(ACL|EMNLP|NAACL|EACL|COLING|LREC|NeurIPS|NIPS|ICLR|ICML|AAAI|IJCAI|INTERSPEECH)"
TRACK = r"(?i)\b(LBD|late[- ]breaking(?: demo| results)?|oral|spotlight|poster|demo(?:nstration)?|industry(?: track)?|short paper|main conference|system demonstration)\b"
TRACKS = (
    ("lbd", "Late-Breaking Demo"), ("late-breaking", "Late-Breaking Demo"), ("late breaking", "Late-Breaking Demo"), ("late-breaking demo", "Late-Breaking Demo"), ("oral", "Oral"), ("spotlight", "Spotlight"), ("poster", "Poster"),
    ("demo", "Demo"), ("demonstration", "Demo"), ("industry", "Industry"), ("industry track", "Industry"), ("short paper", "Short"), ("main conference", "Main"), ("system demonstration", "Demo"),
)
ACCEPTED = r"(?i)\b(accepted|camera[- ]ready|to appear|will appear|published (in|at)|proceedings of)\b"
SUBMITTED = r"(?i)\b(submitted to|under review|in submission|under submission)\b"
CLAIM = r"(?i)(?:accepted|to appear)\s*(?:as|at|by|to|in|for)?\s*(?:the\s+)?([^.;]{3,90})"
WORKSHOP = r"(?i)workshop\s*(?:on\s+([^(,.;]{3,60}))?\s*(?:\(([A-Za-z0-9\-]{2,20})\))?"
ACRONYM = r"\(([A-Za-z][A-Za-z0-9&+\-]{1,15})(?:\s+(?:19|20)\d{2})?\)"
#: Characters between a venue's name and the word workshop, within which the workshop is the venue's.
NEAR = 30
#: Fields of a record, all text but the last.
FIELDS = ("status", "venue_id", "venue_name", "venue_full", "venue_year", "venue_kind", "track", "parent_venue", "display", "evidence_source", "evidence_url", "evidence_quote", "doi", "confidence")


def named(rules: tuple, *forms: Column) -> Column:
    """struct(id, name, kind) of the first rule that a form fits, null of none; rules without a kind have the empty one."""

    def case(*texts: Column) -> Column:
        out = F.lit(None).cast("struct<id:string,name:string,kind:string>")
        for pattern, ident, name, *kind in reversed(rules):
            fits = reduce(Column.__or__, [T.or_empty(x).rlike(f"(?i){pattern}") for x in texts])
            out = F.when(fits, F.struct(F.lit(ident).alias("id"), F.lit(name).alias("name"), F.lit(kind[0] if kind else "").alias("kind"))).otherwise(out)
        return out

    return T.apart(case, *forms)


def _record(df: DataFrame, **fields: Column) -> DataFrame:
    """The common record; fields that a source doesn't give are empty, and confidence is high."""
    fields = {"confidence": F.lit("high")} | fields
    return df.select("id", *[T.or_empty(fields[n]).alias(n) if n in fields else F.lit("").alias(n) for n in FIELDS], F.coalesce(fields.get("needs_review", F.lit(False)), F.lit(False)).alias("needs_review"))


def _plain(title: Column) -> Column:
    return F.trim(F.regexp_replace(T.or_empty(title), "^Proceedings of (the )?", ""))


def _shown(name: Column, year: Column, track: Column | None = None) -> Column:
    return V.display(name, T.or_empty(year), F.lit(None).cast("string") if track is None else F.nullif(track, F.lit("")))


def _first(hits: DataFrame) -> DataFrame:
    return preferred(hits, F.lit(0))


def from_anthology(hits: DataFrame) -> DataFrame:
    """Records from the first hit of each id (id, ord, booktitle, journal, year, url, doi): journals, Findings and proceedings by
    rule, a workshop or another book by its own acronym or title, to be reviewed."""
    e = _first(hits).withColumns({"book": T.or_empty(F.col("booktitle")), "jour": T.or_empty(F.col("journal"))})
    e = e.withColumn("yr", T.or_empty(F.coalesce(T.first_filled(F.col("year")), T.year_of(F.col("book")), T.year_of(F.col("jour")))))
    family = F.upper(F.regexp_extract("book", f"(?i){FINDINGS}", 1))
    findings = named(tuple((f"^{f}$", i, n) for f, i, n in FINDINGS_OF), family)
    e = e.withColumns({"j": named(JOURNALS, F.col("jour")), "f": findings, "b": named(BOOKS, F.col("book"))})
    e = e.withColumn("v", F.coalesce("j", "f", "b"))
    is_findings = F.col("j").isNull() & F.col("f").isNotNull()
    acronym = F.regexp_extract(_plain(F.col("book")), ACRONYM, 1)
    own = F.when((acronym != "") & (acronym != F.lower(acronym)), acronym).otherwise(_plain(F.col("book")))
    e = e.withColumn("own", own)
    name = F.col("v.name")
    full = F.coalesce(T.first_filled(F.col("book")), F.col("jour"))
    own_shown = F.trim(F.concat(F.substring("own", 1, 70), F.when((F.col("yr") != "") & ~F.contains(F.col("own"), F.col("yr")), F.concat(F.lit(" "), F.col("yr"))).otherwise("")))
    shown = F.when(F.col("v").isNull(), own_shown).when(is_findings, F.concat(F.lit("Findings of "), _shown(name, F.col("yr")))).otherwise(_shown(name, F.col("yr")))
    kind = F.when(F.col("j").isNotNull(), "journal").when(F.col("v").isNotNull(), "conference").when(F.col("book").rlike("(?i)workshop"), "workshop").otherwise("other")
    track = F.when(F.col("j").isNull() & F.col("f").isNull() & F.col("b").isNotNull(), F.regexp_extract("book", BOOK_TRACK, 1))
    return _record(
        e, status=F.lit("published"), venue_id=F.col("v.id"), venue_name=F.coalesce(name, F.substring("own", 1, 80)), venue_full=F.when(F.col("v").isNull(), F.col("book")).otherwise(full), venue_year=F.col("yr"), venue_kind=kind, track=track,
        display=shown, evidence_source=F.lit("acl_anthology"), evidence_url=F.col("url"), evidence_quote=full, doi=F.col("doi"), needs_review=F.col("v").isNull(),
    )


def from_isca(hits: DataFrame) -> DataFrame:
    """Records from ISCA hits (id, ord, event: a name and a year, title, url)."""
    e = _first(hits)
    name, year = F.regexp_extract("event", "^(.*) [^ ]*$", 1), F.substring_index("event", " ", -1)
    ident = F.when(name.isin("Interspeech", "Odyssey", "SSW"), F.lower(name))
    return _record(e, status=F.lit("published"), venue_id=ident, venue_name=name, venue_full=F.concat("event", F.lit(" (ISCA Archive)")), venue_year=year, venue_kind=F.lit("conference"), display=_shown(name, year), evidence_source=F.lit("isca_archive"), evidence_url=F.col("url"), evidence_quote=F.col("title"))


def from_crossref(hits: DataFrame) -> DataFrame:
    """Records from Crossref hits (id, ord, type, container, event, year, title, doi, url): a published type before any other; the
    container or else the event names the venue, and a rule's kind goes before the type's."""
    e = preferred(hits, F.when(F.col("type").isin(*PUBLISHED_TYPES), 0).otherwise(1))
    e = e.withColumn("cont", F.coalesce(T.first_filled(F.col("container"), F.col("event")), F.lit("")))
    e = e.withColumns({"v": named(CONTAINERS, F.col("cont"), F.col("event")), "yr": T.or_empty(F.coalesce(T.first_filled(F.col("year")), T.year_of(F.col("cont"))))})
    kind = F.when(F.col("v").isNotNull(), F.col("v.kind")).when(F.col("cont").rlike("(?i)workshop"), "workshop").when(F.col("type") == "journal-article", "journal").otherwise("conference")
    name = F.coalesce("v.name", V.tidy(F.substring(_plain(F.col("cont")), 1, 80)))
    url = F.coalesce(T.first_filled(F.col("url")), F.concat(F.lit("https://doi.org/"), T.or_empty(F.col("doi"))))
    quote = F.concat(F.substring(T.or_empty(F.col("title")), 1, 70), F.lit(" - "), F.col("cont"))
    return _record(
        e, status=F.lit("published"), venue_id=F.col("v.id"), venue_name=name, venue_full=F.col("cont"), venue_year=F.col("yr"), venue_kind=kind, display=_shown(name, F.col("yr")), evidence_source=F.lit("publisher"),
        evidence_url=url, evidence_quote=quote, doi=F.col("doi"), needs_review=F.col("v").isNull(),
    )


def from_openreview(hits: DataFrame) -> DataFrame:
    """Records from OpenReview hits (id, ord, venue, venueid, mirror, decided, url): the group's id names the venue, else the
    venue's text before its year; what stands behind name and year is the track."""
    e = preferred(hits, openreview_rank())
    e = e.withColumns({"v": named(GROUPS, F.col("venueid")), "yr": T.or_empty(F.coalesce(T.year_of(F.col("venue")), T.year_of(F.col("venueid"))))})
    name = F.coalesce("v.name", T.first_filled(F.trim(F.regexp_replace("venue", r"\s*(19|20)\d{2}.*$", "")), F.col("venue")))
    quoted = F.regexp_replace(name, r"([^A-Za-z0-9\s])", r"\\$1")
    track = F.when(F.col("yr") != "", F.trim(F.call_function("regexp_replace", F.col("venue"), F.concat(F.lit("^"), quoted, F.lit(r"\s*"), F.col("yr"), F.lit(r"\s*")), F.lit(""))))
    return _record(
        e, status=F.when(F.col("decided"), "published").otherwise("accepted"), venue_id=F.col("v.id"), venue_name=name, venue_full=F.col("venue"), venue_year=F.col("yr"), venue_kind=F.lit("conference"), track=track,
        display=_shown(name, F.col("yr"), track), evidence_source=F.lit("openreview"), evidence_url=F.col("url"), evidence_quote=F.col("venue"), needs_review=F.col("v").isNull(),
    )


def from_journal_ref(rows: DataFrame) -> DataFrame:
    """Records from the papers' journal references (id, journal_ref, paper); empty ones give none."""
    e = rows.where(T.or_empty(F.col("journal_ref")) != "").withColumn("jr", F.col("journal_ref"))
    e = e.withColumns({"v": F.coalesce(named(CONTAINERS, F.col("jr")), named(BOOKS, F.col("jr"))), "yr": T.or_empty(T.year_of(F.col("jr")))})
    before = F.trim(F.regexp_extract("jr", r"^\s*(?:Published as a conference paper at\s+)?([A-Z][A-Za-z&/\- ]{1,40}?)\s*(19|20)\d{2}", 1))
    name = F.coalesce(F.col("v.name"), F.nullif(before, F.lit("")), F.substring(_plain(F.col("jr")), 1, 60))
    kind = F.coalesce(F.nullif(F.col("v.kind"), F.lit("")), F.lit("conference"))
    return _record(
        e, status=F.lit("published"), venue_id=F.col("v.id"), venue_name=name, venue_full=F.col("jr"), venue_year=F.col("yr"), venue_kind=kind, display=_shown(name, F.col("yr")), evidence_source=F.lit("arxiv_journal_ref"),
        evidence_url=F.concat(F.lit("https://arxiv.org/abs/"), T.or_empty(F.col("paper"))), evidence_quote=F.col("jr"), needs_review=F.col("v").isNull(),
    )


def dblp_rank() -> Column:
    """Only an exact title outside the preprint list decides."""
    return F.when((T.or_empty(F.col("venue")) != "CoRR") & F.coalesce(F.col("title_exact"), F.lit(False)), 0)


def from_dblp(hits: DataFrame) -> DataFrame:
    """Records from DBLP hits (id, ord, venue, year, type, title_exact, key, ee, url, doi)."""
    e = preferred(hits, dblp_rank()).withColumns({"ven": T.or_empty(F.col("venue")), "yr": T.or_empty(F.col("year").cast("string"))})
    word = F.split(F.trim("ven"), r"\s+")[0]
    short = F.lower(word)
    by_index = F.when(F.col("ven").rlike(INDEXED), F.struct(F.when(short == "nips", "neurips").otherwise(short).alias("id"), word.alias("name"), F.lit("").alias("kind")))
    e = e.withColumn("v", F.coalesce(named(CONTAINERS, F.col("ven")), named(BOOKS + JOURNALS, F.col("ven")), by_index))
    kind = F.coalesce(F.nullif(F.col("v.kind"), F.lit("")), F.when(F.col("type") == "Journal Articles", "journal").otherwise("conference"))
    name = F.coalesce(F.col("v.name"), F.substring("ven", 1, 60))
    return _record(
        e, status=F.lit("published"), venue_id=F.col("v.id"), venue_name=name, venue_full=F.col("ven"), venue_year=F.col("yr"), venue_kind=kind, display=_shown(name, F.col("yr")), evidence_source=F.lit("dblp"),
        evidence_url=F.coalesce(T.first_filled(F.col("ee"), F.col("url")), F.lit("https://dblp.org/search?q=")), evidence_quote=F.concat("ven", F.lit(" "), "yr", F.lit(" (DBLP "), T.or_empty(F.col("key")), F.lit(")")), doi=F.col("doi"), needs_review=F.col("v").isNull(),
    )


def accepted(comment: Column) -> Column:
    """FIL-11 of the resolver: an acceptance phrase and no submission phrase."""
    return T.or_empty(comment).rlike(ACCEPTED) & ~T.or_empty(comment).rlike(SUBMITTED)


def from_comment(rows: DataFrame) -> DataFrame:
    """Records from the authors' comments (id, comment, paper) that claim acceptance.

    The claim is what follows the acceptance phrase. A workshop is the named venue's, and the record the workshop's, only if the
    word stands at most NEAR characters behind the name: a comment may name two venues.
    """
    e = rows.where(accepted(F.col("comment")))
    said = F.trim(F.regexp_extract("comment", CLAIM, 1))
    e = e.withColumn("claim", F.when(F.col("comment").rlike(CLAIM), said).otherwise(F.substring("comment", 1, 90)))
    word = F.regexp_extract("claim", SAID, 1)
    low = F.lower(word)
    by_word = F.when(word != "", F.struct(F.when(low == "nips", "neurips").when(low == "acm mm", "acmmm").otherwise(low).alias("id"), word.alias("name"), F.lit("").alias("kind")))
    e = e.withColumns({"yr": T.or_empty(F.coalesce(T.year_of(F.col("claim")), T.year_of(F.col("comment")))), "v": F.coalesce(named(CONTAINERS, F.col("claim")), by_word)})
    e = e.withColumn("name", F.coalesce(F.col("v.name"), F.substring("claim", 1, 60)))
    at, workshop = F.instr(F.lower("claim"), F.lower("name")), F.instr(F.lower("claim"), F.lit("workshop"))
    e = e.withColumn("own", (F.col("name") != "") & (at > 0) & (workshop > 0) & (workshop - at - F.length("name")).between(0, NEAR))
    topic = F.regexp_replace(F.regexp_extract("claim", WORKSHOP, 1), "^[ ,.]+|[ ,.]+$", "")
    wname = F.coalesce(F.nullif(F.regexp_extract("claim", WORKSHOP, 2), F.lit("")), F.nullif(F.substring(topic, 1, 44), F.lit("")), F.lit("Workshop"))
    parent = _shown(F.col("name"), F.col("yr"))
    claimed = F.regexp_extract("claim", TRACK, 1)
    track = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in TRACKS for x in pair]), F.lower(claimed)), claimed)
    findings = F.col("claim").rlike(r"(?i)\bfindings\b")
    shown = F.when(findings, F.concat(F.lit("Findings of "), parent)).otherwise(_shown(F.col("name"), F.col("yr"), track))
    own = lambda yes, no: F.when(F.col("own"), yes).otherwise(no)
    return _record(
        e, status=F.lit("accepted"), venue_id=F.when(~F.col("own"), F.col("v.id")), venue_name=own(wname, V.tidy(F.col("name"))), venue_full=F.col("claim"), venue_year=F.col("yr"), venue_kind=own(F.lit("workshop"), F.lit("conference")), track=own(F.lit(""), track),
        parent_venue=F.when(F.col("own"), parent), display=own(F.trim(F.concat(parent, F.lit(" "), wname, F.lit(" Workshop"))), shown), evidence_source=F.lit("arxiv_comment"), evidence_url=F.concat(F.lit("https://arxiv.org/abs/"), T.or_empty(F.col("paper"))),
        evidence_quote=F.substring("comment", 1, 200), confidence=F.lit("medium"), needs_review=F.col("own") | F.col("v").isNull(),
    )


def resolved(entries: DataFrame, records: list[DataFrame]) -> DataFrame:
    """JN-13: for each entry (id, paper, comment) the record of the first source that has one, in the order of the list; else a preprint's.

    All records are tagged with their source's place and combined by one aggregation, whole records at a time.
    """
    cells = [*FIELDS, "needs_review"]
    tagged = [r.select("id", F.lit(k).alias("place"), F.struct(*cells).alias("r")) for k, r in enumerate(records)]
    best = reduce(DataFrame.unionByName, tagged).groupBy("id").agg(F.min_by("r", "place").alias("r"))
    quote = F.coalesce(T.first_filled(F.substring("comment", 1, 160)), F.lit("no journal reference, no acceptance note"))
    given = {"status": F.lit("preprint"), "evidence_source": F.lit("arxiv"), "evidence_url": F.concat(F.lit("https://arxiv.org/abs/"), T.or_empty(F.col("paper"))), "evidence_quote": quote, "confidence": F.lit("high")}
    none = F.struct(*[given.get(n, F.lit("")).alias(n) for n in FIELDS], F.lit(False).alias("needs_review"))
    return entries.join(many(best), "id", "left").select("id", F.coalesce("r", none).alias("r")).select("id", "r.*")


def family_agreement(records: DataFrame, others: DataFrame) -> DataFrame:
    """JN-14: id, agree and disagree: of the records (resolved) the other sources whose venue is of the same family, and of another.

    others: id, source, text, at most one row for each id and source; the source that a record rests on doesn't count. Families
    are found once for each distinct text; texts of no family neither agree nor disagree. Lists are by source name.
    """
    mine = records.select("id", F.col("evidence_source").alias("used"), F.coalesce(*[T.first_filled(F.col(c)) for c in ("display", "venue_full", "venue_name")], F.lit("")).alias("text"))
    texts = mine.select("text").unionByName(others.select("text")).distinct()
    families = texts.select("text", V.family(F.col("text")).alias("family")).where("family is not null")
    of = lambda df, name: df.join(many(families), "text").drop("text").withColumnRenamed("family", name)
    pairs = of(others.select("id", "source", "text"), "theirs").join(many(of(mine, "own")), "id")
    # Crossref's records are the publisher's
    pairs = pairs.where(F.when(F.col("source") == "crossref", "publisher").otherwise(F.col("source")) != F.col("used"))
    same = F.col("theirs") == F.col("own")
    return pairs.groupBy("id").agg(F.array_sort(F.collect_set(F.when(same, F.col("source")))).alias("agree"), F.array_sort(F.collect_set(F.when(~same, F.col("source")))).alias("disagree"))
