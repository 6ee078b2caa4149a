"""Explicit schemas of the catalogue's inputs; nothing is inferred. `_ord` is a row's place in its source."""

from __future__ import annotations

CELLS = "benchmark STRING, model STRING, metric STRING, value VARIANT, source STRING, source_url STRING, note STRING"
CELLS_RAW = "benchmark STRING, model_raw STRING, metric STRING, value VARIANT, source STRING, source_arxiv STRING, note STRING"
BENCHMARKS = (
    "id STRING, name STRING, full_title STRING, arxiv_id STRING, arxiv_date STRING, arxiv_date_full STRING, url STRING, code STRING, data STRING, "
    "leaderboard STRING, summary STRING, categories ARRAY<STRING>, tasks ARRAY<STRING>, languages ARRAY<STRING>, metrics ARRAY<STRING>, io STRING, "
    "size STRING, aka ARRAY<STRING>, note STRING"
)
MODELS = "id STRING, name STRING, org STRING, type STRING"
CATEGORIES = "id STRING, name STRING, `group` STRING, blurb STRING, example_metrics STRING"
PAPERS = (
    "id STRING, version INT, title STRING, abstract STRING, published STRING, updated STRING, authors ARRAY<STRING>, primary_category STRING, "
    "categories ARRAY<STRING>, comment STRING, url STRING, score INT, found_by ARRAY<INT>, found_in ARRAY<STRING>"
)
MENTIONS = "name STRING, full_title STRING, arxiv_id STRING, url STRING, year STRING, category_guess STRING, one_line STRING, evidence STRING"
SEEN = "id STRING, title STRING, published STRING, score INT"
LEDGER = "id STRING, title STRING, published STRING, score INT, verdict STRING, catalogue_id STRING, outcome STRING"
VENUES = (
    "id STRING, status STRING, venue STRING, venue_name_raw STRING, venue_full STRING, year STRING, kind STRING, track STRING, parent_venue STRING, "
    "display STRING, evidence STRING, evidence_url STRING, evidence_quote STRING, doi STRING, confidence STRING, verified STRING, publishable BOOLEAN, note STRING"
)
EVIDENCE = (
    "source STRING, id STRING, hit_ord INT, match STRING, score DOUBLE, title STRING, authors ARRAY<STRING>, container STRING, event STRING, "
    "venueid STRING, year STRING, type STRING, url STRING, doi STRING, extra MAP<STRING,STRING>"
)
CITES = "benchmark STRING, citing STRING, title STRING, year INT, venue STRING, cited_by INT, reports_score INT"
