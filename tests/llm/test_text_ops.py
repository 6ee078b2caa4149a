"""Pseudonyms, packing, language, quality, page text and language-model scores."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from colophon.llm import html_text as H
from colophon.llm import language, lm_score, packing, privacy, quality
from colophon.llm.queries import tokenizer_path

DOC = "doc_id long, text string, score double, lang string"


def docs_of(spark, rows):
    return spark.createDataFrame([(r[0], r[1], 0.5, r[2] if len(r) > 2 else "x") for r in rows], DOC).repartition(2)


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def pseudonyms(spark, rows):
    return {r["doc_id"]: r for r in privacy.pseudonymise(docs_of(spark, rows), "key").collect()}


def test_pseudonyms(spark):
    rows = [
        (1, "card 4111-1111-1111-1111, not 4111111111111112; ip 10.1.2.3 not 999.1.1.1; mail Foo.Bär@example.com!"),
        (2, "4111 1111 1111 1111 iban DE89 3704 0044 0532 0130 00, not DE88 3704 0044 0532 0130 00"),
        (3, "born 1990-05-06 or 06/05/1990, never 2001-02-29 or 1990-13-01"),
        (4, 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" +1 (017) 555-7713 ssn 123-45-6789 not 666-45-6789'),
        (5, None), (6, ""), (7, "version 1.2.3 of 12 items at 10:30, page 1234567"), (8, "x" * 200_000 + " 10.1.2.3 " + "9" * 5000), (None, "10.1.2.3"), (9, "10.1.2.3"), (9, "10.1.2.3"),
    ]
    got = pseudonyms(spark, rows)
    a = re.fullmatch(r"card (\d{4}-\d{4}-\d{4}-\d{4}), not 4111111111111112; ip (\d+\.\d+\.\d+\.\d+) not 999.1.1.1; mail (\S+@\S+)!", got[1]["text"])
    card, ip = a[1].replace("-", ""), a[2]
    assert luhn(card) and card != "4111111111111111" and ip != "10.1.2.3" and all(int(x) < 256 for x in ip.split("."))
    b = re.fullmatch(r"(\d{4} \d{4} \d{4} \d{4}) iban (DE\d\d(?: \d{4}){4} \d\d), not DE88 3704 0044 0532 0130 00", got[2]["text"])
    assert b[1].replace(" ", "") == card  # linked, whatever the punctuation
    n = b[2].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in n[4:] + n[:4])) % 97 == 1 and n != "DE89370400440532013000"
    c = re.fullmatch(r"born (\d{4})-(\d\d)-(\d\d) or (\d\d)/(\d\d)/(\d{4}), never 2001-02-29 or 1990-13-01", got[3]["text"])
    assert (c[1], c[2], c[3]) == (c[6], c[5], c[4]) and (c[1], c[2], c[3]) != ("1990", "05", "06")
    d = re.fullmatch(r'token = "([0-9a-f]{40})" \+1 \((\d{3})\) (\d{3})-(\d{4}) ssn (\d{3}-\d\d-\d{4}) not 666-45-6789', got[4]["text"])
    assert d and d[1] != "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" and d[5] != "123-45-6789"
    assert [got[k]["kinds"] for k in (1, 2, 3, 4)] == [["card", "ip", "mail"], ["card", "iban"], ["date"], ["phone", "secret", "ssn"]]
    assert got[5]["text"] is None and got[6]["text"] == "" and got[7]["text"] == rows[6][1] and got[7]["n_found"] == 0
    assert got[8]["text"] == rows[7][1].replace("10.1.2.3", ip) and got[None]["text"] == ip
    assert privacy.pseudonymise(docs_of(spark, []), "key").count() == 0


def test_pseudonyms_beside_other_numbers(spark):
    rows = [
        (1, "card 4111 1111 1111 1111 12/25"), (2, "4111111111111111 123"), (3, "no 12 4111-1111-1111-1111"), (4, "BE68 5390 0754 7034 BIC"), (5, "0987-06-05 and 2525-01-01 and 9999-12-31"),
        (6, "a" * 90 + "@example.com"), (7, "key " + "0f" * 150), (8, "4111 1111 1111 1111 1111 1111"), (9, "4111 1111 1111 1112 12/25"),
    ]
    got = {k: r["text"] for k, r in pseudonyms(spark, rows).items()}
    card = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) 12/25", got[1])[1].replace(" ", "")
    assert luhn(card) and got[2] == f"{card} 123" and got[3].replace("-", "") == f"no 12 {card}"
    assert re.fullmatch(r"BE\d\d \d{4} \d{4} \d{4} BIC", got[4]) and got[4] != rows[3][1]
    dates = re.findall(r"\d{4}-\d\d-\d\d", got[5])
    assert got[8] == f"{' '.join(card[k : k + 4] for k in range(0, 16, 4))} 1111 1111"
    assert len(dates) == 3 and "0001" <= dates[0][:4] < "1900" and all("2100" <= d[:4] for d in dates[1:]) and got[5] != rows[4][1]
    assert "aaa" not in got[6] and re.fullmatch("key [0-9a-f]{300}", got[7]) and got[7] != rows[6][1] and got[9] == rows[8][1]


def test_cards_beside_any_numbers(spark):
    """A card is found whatever numbers stand before and behind it, with separators of either kind, and other data after it."""
    rng = random.Random(9)
    cards = ["4111 1111 1111 1111", "5500-0055-5555-5559", "3782 822463 10005", "6011111111111117", "4222222222222", "30569309025904"]
    number = lambda: "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 8)))
    rows = []
    for k in range(300):
        card, sep = rng.choice(cards), rng.choice(" -")
        before, behind = ([number() for _ in range(rng.randint(0, 3))] for _ in range(2))
        rows.append((k, sep.join([*before, card, *behind]), card))
    rows += [(900, "2024 4111 1111 1111 1111", cards[0]), (901, "1234 5678 9012 4111 1111 1111 1111", cards[0]), (902, "4111 1111 1111 1111 123-45-6789 x", cards[0]), (903, "4111 1111 1111 1111 4222222222222", cards[0])]
    got = {r["doc_id"]: r for r in privacy.pseudonymise(docs_of(spark, [r[:2] for r in rows]), "key").collect()}
    assert all(card not in got[k]["text"] and got[k]["n_found"] > 0 and len(got[k]["text"]) == len(text) for k, text, card in rows)
    shown = got[900]["text"][5:]
    assert got[900]["text"].startswith("2024 ") and got[901]["text"] == f"1234 5678 9012 {shown}" and got[903]["n_found"] == 2 and got[903]["text"].startswith(shown)
    assert got[902]["text"].startswith(f"{shown} ") and "123-45-6789" not in got[902]["text"] and got[902]["kinds"] == ["card", "ssn"]
    plain = ["1 " * 40_000, "12345678901234 " * 3 + "x" * 100_000, "1" * 100_000, "12-" * 30_000 + "a"]  # long chains take time in proportion
    again = {r["doc_id"]: r["text"] for r in privacy.pseudonymise(docs_of(spark, list(enumerate(plain))), "key").collect()}
    assert all(len(again[k]) == len(t) for k, t in enumerate(plain)) and again[2] == plain[2]


def plain_network(a, b, range_a, range_b, tag, key):
    for i in range(1, privacy.ROUNDS + 1):
        m = range_a if i % 2 else range_b
        a, b = b, (a + int(hashlib.sha256(f"{key}|{tag}|{range_a}|{range_b}|{i}|{b}".encode()).hexdigest()[:15], 16)) % m
    return a, b


def test_pseudonyms_are_those_of_plain_arithmetic(spark):
    rng = random.Random(3)
    ips = [tuple(rng.randrange(256) for _ in range(4)) for _ in range(40)]
    days = [date(1900, 1, 1) + timedelta(rng.randrange(73170)) for _ in range(40)]
    ssn = [(rng.choice([1, 300, 665, 667, 899]), rng.randint(1, 99), rng.randint(1, 9999)) for _ in range(40)]
    cards = [x + str(next(c for c in range(10) if luhn(x + str(c)))) for x in ("".join(rng.choice("123456789") for _ in range(15)) for _ in range(40))]
    rows = [(k, f"{'.'.join(map(str, ips[k]))} {days[k]} {ssn[k][0]:03}-{ssn[k][1]:02}-{ssn[k][2]:04} x {cards[k]}") for k in range(40)]
    got = pseudonyms(spark, rows)
    for k in range(40):
        a, b = plain_network(ips[k][0] * 256 + ips[k][1], ips[k][2] * 256 + ips[k][3], 65536, 65536, "ip", "key")
        n = (days[k] - date(1900, 1, 1)).days
        c, d = plain_network(n // 271, n % 271, 270, 271, "date", "key")
        e, f = plain_network(ssn[k][0] - 1 - (ssn[k][0] > 666), (ssn[k][1] - 1) * 9999 + ssn[k][2] - 1, 898, 99 * 9999, "ssn", "key")
        g, h = plain_network(int(cards[k][:7]), int(cards[k][7:15]), 10**7, 10**8, "card", "key")
        whole = f"{g:07}{h:08}"
        want = f"{a // 256}.{a % 256}.{b // 256}.{b % 256} {date(1900, 1, 1) + timedelta(c * 271 + d)} {e + 1 + (e >= 665):03}-{f // 9999 + 1:02}-{f % 9999 + 1:04} x {whole}{next(x for x in range(10) if luhn(whole + str(x)))}"
        assert got[k]["text"] == want


def test_permutation_is_one_to_one_and_inverts(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    df = df.withColumn("e", privacy.permuted_digits(F.col("d"), "t", "k")).withColumn("f", privacy.permuted_digits(F.col("e"), "t", "k", invert=True))
    rows = df.collect()
    assert len({r["e"] for r in rows}) == 1000 and all(r["f"] == r["d"] and len(r["e"]) == 3 for r in rows)
    long = spark.createDataFrame([("7" * 30,)], "d string")
    r = long.withColumn("e", privacy.permuted_digits(F.col("d"), "t", "k")).withColumn("f", privacy.permuted_digits(F.col("e"), "t", "k", invert=True)).first()
    assert r["f"] == r["d"] != r["e"]


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(2)
    rows = [(k, "".join(rng.choice(" \n\tabcé日!9'<|") for _ in range(rng.randint(0, 400)))) for k in range(60)]
    rows += [(70, None), (71, ""), (72, "word " * 9000), (73, "<|endoftext|> a"), (None, "a b")]
    got = packing.pack(docs_of(spark, rows), tokenizer_path(), 64).collect()
    pieces, sequences = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        pieces.setdefault(r["doc_id"], []).append((r["start"], ids, r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in rows:
        want = tok.encode(t or "", add_special_tokens=False).ids + [1]
        parts = sorted(pieces[i])
        assert [x for p in parts for x in p[1]] == want and all(p[2] == len(want) for p in parts)
        assert all(p[0] == sum(len(q[1]) for q in parts[:k]) for k, p in enumerate(parts))
    for k, s in sequences.items():
        s.sort()
        assert all(o == sum(n for _, n in s[:j]) for j, (o, _) in enumerate(s))
        assert sum(n for _, n in s) == 64 or k == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))
    assert packing.pack(docs_of(spark, []), tokenizer_path()).count() == 0
    # repeated rows are packed as often as they come
    twice = packing.pack(docs_of(spark, [(1, "a b"), (1, "a b")]), tokenizer_path())
    assert twice.agg(F.sum("length")).first()[0] == 2 * (len(tok.encode("a b").ids) + 1)


def test_long_white_space_and_added_tokens(spark):
    """Runs of two million spaces, newlines or tabs, and the strings of added tokens, as by tokenizers."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    texts = [c * 2_000_000 + "end" for c in " \n\t"] + ["a <|endoftext|> x", "<|endoftext|>", "plain", "w" * 300_000, "\u2003" * 200_000]
    rows = packing.pack(docs_of(spark, list(enumerate(texts))), tokenizer_path(), 4096).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "ids"))).alias("p")).collect()
    for r in rows:
        ids = np.frombuffer(b"".join(p["ids"] for p in r["p"]), "<u4").tolist()
        assert ids == [*tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1]
    assert len(rows) == len(texts)


def test_texts_are_encoded_as_by_tokenizers():
    from tokenizers import Tokenizer

    w = packing._Encoder(tokenizer_path())
    assert w.ranked is not None
    rng = random.Random(1)
    xs = ["".join(rng.choice(" \n\tab1!é' s-日") for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    xs += ["a" * 30_000, " " * 30_000, "日本" * 9000, "<|endoftext|>", "!?" * 20_000 + " x"]
    tok = Tokenizer.from_file(tokenizer_path())
    want = [e.ids for e in tok.encode_batch(xs, add_special_tokens=False)]
    assert [np.frombuffer(b, w.kind).tolist() for b in w.encode(xs)] == want


def test_language(spark, small):
    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    out = language.identify(docs, ~held, keep=["doc_id", "lang"]).where(held).collect()
    assert len(out) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.98
    assert np.mean([r["rejected"] for r in out]) < 0.01


def test_counts_of_slices_are_those_of_the_whole(monkeypatch):
    text = "Der Hund, und die Katze! " * 400
    whole = language.counts(text)
    monkeypatch.setattr(language, "SLICE", 100)
    assert len(list(language._slices(text))) > 50 and "".join(language._slices(text)) == text
    assert 0 <= (whole - language.counts(text)).sum() < 2 * 100  # less a group across each cut


def test_short_texts_of_other_languages_are_rejected(spark, small):
    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    other = ["Это короткий текст на другом языке", "这是一个简短的文本，用另一种语言写成", "これは短いテキストです", "هذا نص قصير بلغة أخرى"]
    rows = docs.unionByName(spark.createDataFrame([(900000 + k, t, None) for k, t in enumerate(other)], docs.schema))
    out = language.identify(rows, F.col("doc_id") < 900000).where("doc_id >= 900000").collect()
    assert len(out) == 4 and all(r["rejected"] for r in out)
    model = language.fit(docs)
    texts = [r["text"] for r in docs.collect() if r["text"]]
    pieces = [" ".join(t.split()[5 : 5 + n]) for t in texts[::5] for n in (1, 2, 5, 20) if len(t.split()) > 30]
    assert np.mean(model.predict(np.stack([language.counts(t) for t in pieces]))[2]) < 0.01


def test_nearest_centroid_is_that_of_plain_arithmetic(spark):
    rows = [(k, t, lang) for k, (t, lang) in enumerate([("the cat and the dog", "en"), ("of the house and me", "en"), ("der hund und die katze", "de"), ("von dem haus und mir", "de")] * 3)]
    model = language.fit(docs_of(spark, rows))
    for t in ("the house of a dog", "die katze von dem hund", "xyz qqq"):
        v = np.array([math.log1p(c) * w for c, w in zip(language.counts(t).tolist(), model.idf.tolist(), strict=True)])
        cos = [float(v @ m) / math.sqrt(float(v @ v)) for m in model.matrix]
        assert model.predict(language.counts(t)[None])[0] == [model.languages[int(np.argmax(cos))]]


def test_language_edges(spark):
    rows = [(k, "the cat and the dog of the house " * 3, "en") for k in range(8)] + [(10 + k, "der hund und die katze von dem haus " * 3, "de") for k in range(8)]
    rows += [(30, None, "en"), (31, "", "en"), (32, "12 !! 34", "de"), (33, "und die katze", None), (None, "the dog", "en"), (34, "the " * 50_000, None), (1, rows[1][1], "en")]
    docs = docs_of(spark, [r if r[2] else (r[0], r[1], None) for r in rows])
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    for marks in ("½", "²", "①", "ⅷ ¹²³", "_ 12"):
        assert not language.LETTER.search(marks)
    assert [got[k]["lang_pred"] for k in (30, 31, 32, 33, None, 34)] == ["und", "und", "und", "de", "en", "en"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[30]["rejected"] and not got[33]["rejected"]
    assert language.identify(docs).count() == len(rows)
    assert {r["lang_pred"] for r in language.identify(docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(docs_of(spark, [])).count() == 0


def test_quality_held_out(spark, small):
    d = small.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    out = quality.quality(docs, labels, ~held).join(labels.where(held), "doc_id").collect()
    good, bad = ([r["score"] for r in out if r["quality"] == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in out]) > 0.93
    assert all((r["predicted"] == 1) == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in out)


def test_quality_scores_are_those_of_plain_arithmetic(spark):
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice("some plain words of a text that reads well enough".split()) for _ in range(rng.randint(20, 60))).capitalize() + "."
    bad = lambda: "".join(rng.choice("#$%&@!? ab1") for _ in range(rng.randint(20, 200)))
    rows = [(k, good() if k % 3 else bad()) for k in range(90)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(80)] + [(85, 0), (85, 1)], "doc_id long, quality int")
    docs = docs_of(spark, rows)
    model = quality.fit(docs, labels)
    raw = {k: sum(float(w) for x, cuts, ws in zip(quality.features(t).tolist(), model.cuts, model.weights.reshape(model.cuts.shape), strict=True) for c, w in zip(cuts, ws, strict=True) if np.float32(x) > c) for k, t in rows}
    taught = sorted(raw[k] for k in range(80))
    cut = taught[math.ceil(sum(k % 3 == 0 for k in range(80)) / 80 * 80) - 1]
    for r in quality.quality(docs, labels).collect():
        assert math.isclose(r["score"], 1 / (1 + math.exp(-(raw[r["doc_id"]] - cut + math.log(0.7 / 0.3)))), rel_tol=1e-3)


def test_quality_edges(spark):
    docs = docs_of(spark, [(1, "a good text of some words.\nAnd more."), (2, "%%% ### $$$"), (3, None), (4, ""), (None, "x"), (5, "w " * 60_000), (1, "a good text of some words.\nAnd more.")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1), (5, 1), (5, 0), (9, 0)], "doc_id long, quality int")
    out = quality.quality(docs, labels).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in quality.quality(docs, labels.where("quality = 1")).collect()} == {0.5}
    assert quality.quality(docs_of(spark, []), labels).count() == 0


def test_field_on_other_templates():
    model = H.train(H.labelled_pages(200), 4)
    pages = H.labelled_pages(60, 77)
    right = [y == z for b, ys in pages for y, z in zip(ys, model.decode(H.block_features(b)), strict=True)]
    assert np.mean(right) > 0.96


def test_viterbi_and_gradient_are_right():
    rng = np.random.default_rng(0)
    model = H.Field(rng.normal(size=(H.DIMS, 2)), rng.normal(size=(3, 2)))
    feats = [[1, 2], [3], [4, 5, 6], [7]]
    score = lambda y: sum(model.state[f].sum(axis=0)[k] for f, k in zip(feats, y, strict=True)) + model.step[2, y[0]] + sum(model.step[a, b] for a, b in zip(y, y[1:], strict=False))
    paths = [[int(c) for c in f"{k:04b}"] for k in range(16)]
    assert model.decode(feats) == max(paths, key=score)
    z = np.array([score(y) for y in paths])
    p = np.exp(z - np.logaddexp.reduce(z))
    state, step = H._gradient(model, feats, [1, 0, 1, 1])
    want = np.array([[sum(q for q, y in zip(p, paths, strict=True) if y[k] == v) for v in (0, 1)] for k in range(4)])
    assert np.allclose(state, np.eye(2)[[1, 0, 1, 1]] - want)
    assert np.isclose(step[:2].sum(), 0) and np.isclose(step[2].sum(), 0)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><p>My site</p></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>
<div class="cookie-notice">We use cookies to improve things.</div><div class="wrap"><article><h1>A &amp; B</h1><p>First   paragraph &lt;here&gt;
of the text, with some words.<p>Second one, left open, is a longer paragraph of plain prose.</p><div class="ad">Buy now!</div>
<form><label>Your mail</label><input name=q></form><p hidden>secret</p><p>Third and last paragraph of this story.</p></article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/x">Other story</a></li></ul></aside></div>
<div id="comments"><h3>Comments</h3><p>Nice one, I liked it a lot!</p></div><footer>&copy; 2024 Us</footer>"""


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "just text"), (None, "u", "<p>" * 3000 + "x"), (5, "u", "<!-- open"), (6, "u", "<script>" * 50), (1, "u", PAGE)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = H.extract(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == "A & B\n\nFirst paragraph <here> of the text, with some words.\n\nSecond one, left open, is a longer paragraph of plain prose.\n\nThird and last paragraph of this story."
    assert by[2] == by[3] == by[5] == by[6] == ""
    assert H.extract(df.limit(0)).count() == 0


def test_article_of_the_tables_pages(spark, small):
    import html

    for r in H.extract(spark.read.parquet(f"{small}/pages.parquet")).join(spark.read.parquet(f"{small}/pages.parquet"), ["page_id", "url"]).collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("chunk", [8_000_000, 50])
def test_lm_scores(spark, chunk):
    rng = random.Random(6)
    say = lambda ws: " ".join(rng.choice(ws) for _ in range(rng.randint(5, 40)))
    rows = [(k, say(("the cat sat on a mat and Dog" if k % 2 else "le chat noir est sur un TAPIS").split())) for k in range(120)]
    rows += [(200, None), (201, ""), (202, "never seen"), (None, "the cat"), (203, "the " * 20_000), (5, rows[5][1])]
    held = F.col("doc_id") % 5 == 0
    got = lm_score.lm_scores(docs_of(spark, rows), held, chunk).collect()
    assert len(got) == len(rows)
    train = Counter()
    for i, t in rows:
        if i is None or i % 5:
            train.update((t or "").encode().lower().split() + ["END"])
    n, v = sum(train.values()), len(train)
    text = dict(rows)
    for r in got:
        w = (text[r["doc_id"]] or "").encode().lower().split() + ["END"]
        assert r["n_tokens"] == len(w) and r["n_known"] == sum(train[x] > 0 for x in w) and r["train_tokens"] == n
        assert math.isclose(r["base_score"], sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r["score"] < 0 and r["held_out"] == (r["doc_id"] is not None and r["doc_id"] % 5 == 0)
    out = [r for r in got if r["held_out"] and r["n_tokens"] > 5]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    if chunk > 50:
        assert lm_score.lm_scores(docs_of(spark, []), held).count() == 0
        none = lm_score.lm_scores(docs_of(spark, rows[:3]), F.lit(True)).collect()
        assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in none)


def test_classes_sum_to_one():
    rng = np.random.default_rng(1)
    w = rng.normal(size=(1 + 2 * lm_score.CLASSES + lm_score.PAIRS, lm_score.CLASSES)).astype(np.float32)
    assert np.allclose(lm_score.class_table(w).sum(axis=2), 1, atol=1e-4)


def test_model_is_that_of_plain_counting(spark):
    """Scores from dictionaries of counts, and the sum over all words, known or not."""
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(["red", "blue", "greenish", "yellowish", "a", "of"][: 3 + k % 4]) for _ in range(rng.randint(0, 12)))) for k in range(80)]
    docs, held = docs_of(spark, rows), F.col("doc_id") % 4 == 0
    m = lm_score.fit(docs, held)[0]
    cls = lambda w: lm_score.END if w is None else lm_score.START if w == "" else lm_score.word_class(w.encode())
    own = lambda w: zlib.crc32(w.encode()) >> 24 if w else 0
    group = lambda w: cls(w) * lm_score.GROUPS + own(w) % lm_score.GROUPS
    before = lambda w: cls(w) * lm_score.BEFORE + own(w) // lm_score.GROUPS % lm_score.BEFORE
    tokens = lambda t: [(u, v, w) for u, v, w in zip(["", "", *t.split()], ["", *t.split()], [*t.split(), None], strict=False)]
    train = [x for k, t in rows if k % 4 for x in tokens(t)]
    words = Counter(w for _, _, w in train)
    size, kinds = Counter(), Counter()
    for w, c in words.items():
        size[group(w)] += c
        kinds[group(w)] += w is not None
    mass = {g: size[g] + (kinds[g] + 1 if g // lm_score.GROUPS != lm_score.END else 1) for g in [*range(lm_score.END * lm_score.GROUPS), lm_score.END * lm_score.GROUPS]}
    in_class = Counter()
    for g, x in mass.items():
        in_class[g // lm_score.GROUPS] += x
    after = [Counter((before(x[1 - j]), group(x[2])) for x in train) for j in (0, 1)]
    after_class = [Counter((before(x[1 - j]), cls(x[2])) for x in train) for j in (0, 1)]
    after_all = [Counter(before(x[1 - j]) for x in train) for j in (0, 1)]
    d = lm_score.DRAW

    def chance(u, v, c, g):
        h = before(v), before(u)
        share = mass.get(g, 0) / in_class[c]
        of_class = [m.triples[cls(u), cls(v), c], *((after_class[j][h[j], c] + d * in_class[c] / sum(mass.values())) / (after_all[j][h[j]] + d) for j in (0, 1))]
        of_group = [share, *((after[j][h[j], g] + d * share) / (after_class[j][h[j], c] + d) for j in (0, 1))]
        return float(m.mix[0] @ np.array(of_class)) * float(m.mix[1] @ np.array(of_group))

    got = {r["doc_id"]: r["score"] for r in lm_score.lm_scores(docs, held).collect()}
    for k, t in rows[::7]:
        want = sum(math.log10(chance(u, v, cls(w), group(w)) * (1 if w is None else (words[w] + 1) / (size[group(w)] + kinds[group(w)] + 1))) for u, v, w in tokens(t))
        assert math.isclose(got[k], want, rel_tol=1e-4)
    for u, v in (("", ""), ("red", "of"), ("never", "seen")):
        assert math.isclose(sum(chance(u, v, g // lm_score.GROUPS, g) for g in mass), 1, rel_tol=1e-4)  # a group's words, and its unknown ones, share it wholly


def test_packed_arrays_come_back():
    rng = np.random.default_rng(0)
    arrays = [rng.integers(0, 99, 1000).astype("<i4"), np.empty(0, "<i8"), rng.integers(-(2**62), 2**62, 7), np.array([1], np.uint8)]
    back = lm_score._unpacked(lm_score._packed(*arrays))
    assert all(x.dtype == y.dtype and (x == y).all() for x, y in zip(arrays, back, strict=True))


def test_contexts_start_anew_in_each_text():
    now, one, two = lm_score._contexts(np.array([5, 6, 7]), np.array([2, 0, 1]))
    e, s = lm_score.END, lm_score.START
    assert now.tolist() == [5, 6, e, e, 7, e] and one.tolist() == [s, 5, 6, s, s, 7] and two.tolist() == [s, s, 5, s, s, s]


def test_bucket_is_crc32_of_the_id(spark):
    from colophon.llm._common import bucket_of

    got = spark.range(50).select("id", bucket_of(F.col("id"), 7).alias("b")).collect()
    assert all(r["b"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in got)
