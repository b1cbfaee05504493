"""Operators 11 to 13 on small tables with every odd case, each against brute force or the library itself."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest

from forgelake.llm import filter_audit, periodic_runs, pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, part string, mask int, n long, name string, runs string, ids string, d string"
LABELS = "doc_id long, quality int, toxic int, part string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def texts():
    rng = random.Random(11)
    names = [f"w{i}" for i in range(400)] + ["É", "ß", "中文", "don't"]
    out = [" ".join(rng.choice(names) for _ in range(rng.choice([5, 60, 110, 150]))) for _ in range(40)]
    out += [t.upper() for t in out[:4]] + [t + " 100% & more" for t in out[4:8]] + out[8:14] * 2 + [out[20]] * 30
    out += ["spam " * 130, ("one two three " * 60), "a b " * 20 + "a " + "a b " * 20, "x y z x y z x y z x y z x"]
    out += [None, "", " \t\r\n\x0b\x0c", "A" * 50, "#", "word", "​A B", "▁▁ ▁x", "tab\tand\nnewline  double", "😀 é́ \x00 <s> </s> <0x41>"]
    out += ["".join(rng.choice("ab ") for _ in range(3000)), "z" * 5000]
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, ("en", "fr", None, "")[i % 4]) for i, t in enumerate(texts())]
    return out + [(9, out[9][1], "en"), (9, out[9][1], "fr"), (None, out[3][1], "en"), (None, out[3][1], "en"), (None, None, None), (500, out[3][1], "de")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, "n", "r", "i", "d") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 11 ---------------------------------------------------------------------------------------


LABELLED = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (9, None, 1), (9, 1, None), (20, 1, 0), (50, 0, None), (60, 1, 1), (None, 1, 1), (9999, 1, 1)]


def brute_masks(rows, labels):
    """(part, set of failed letters, good, toxic) per row."""
    out = []
    for doc_id, text, lang in rows:
        t = text or ""
        w = WORD.findall(t)
        fails = {"A"} if len(w) < 100 else set()
        fails |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        fails |= {"D"} if re.search("[#$%&*|]", t) else set()
        fails |= {"E"} if doc_id is not None and any((o or "") == t and i is not None and i < doc_id for i, o, _ in rows) else set()
        mine = [x for x in labels if doc_id is not None and x[0] == doc_id]
        out.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    return out


def brute_audit(masks):
    out = []
    for part in {m[0] for m in masks}:
        mine = [m for m in masks if m[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in map("".join, permutations("ABCDE")):
            gone = [False] * len(mine)
            for step, f in enumerate(order, 1):
                here = [k for k, m in enumerate(mine) if f in m[1] and not gone[k]]
                redundant = sum(f in m[1] and gone[k] for k, m in enumerate(mine))
                for k in here:
                    gone[k] = True
                shapley[f] += len(here)
                only = sum(m[1] == {f} for m in mine)
                lines.append((part, order, step, gone.count(False), len(here), redundant, only, sum(mine[k][2] for k in here), sum(mine[k][3] for k in here), f))
        out += [(*x[:-1], shapley[x[-1]]) for x in lines]
    return sorted(out)


def test_filter_audit(spark, docs, none, rows):
    labels = spark.createDataFrame([(*x, "p") for x in LABELLED], LABELS)
    got = filter_audit.audit(docs, labels)
    want = brute_audit(brute_masks(rows, LABELLED))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert {f for x in want for f in x[1]} == set("ABCDE") and all(any(x[c] for x in want) for c in range(3, 10))
    assert filter_audit.audit(none, labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).filter("good_lost + toxic_lost > 0").count() == 0


def test_filter_audit_sql(spark, rows, tmp_path):
    """The registered SQL on the same odd rows."""
    import pandas as pd

    con = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"})
    labels = pd.DataFrame(LABELLED, columns=["doc_id", "quality", "toxic"]).astype("Int64")
    con.register("documents", documents)
    con.register("labels", labels)
    assert sorted(con.sql(filter_audit.ORACLE_SQL).fetchall()) == brute_audit(brute_masks(rows, LABELLED))


def test_wide_counters_hold_large_counts(spark):
    """Fields next to each other near the width of a long, summed over masks, come out whole."""
    counted = spark.createDataFrame([("p", m, bool(m & 1), False, 2**50 + m) for m in range(32)], "part string, mask int, good boolean, toxic boolean, n long")
    got = {(r.filter_order, r.step): r for r in filter_audit.interactions(counted, "ABCDE").collect()}
    first = got["ABCDE", 1]
    fails = sum(2**50 + m for m in range(32) if m & 1)
    assert (first.removed, first.kept, first.redundant, first.good_lost) == (fails, sum(2**50 + m for m in range(32) if not m & 1), 0, fails)
    assert got["BACDE", 5].kept == 2**50 and got["EDCBA", 5].redundant == sum(2**50 + m for m in range(32) if m & 1 and m > 1)
    assert filter_audit.unpacked(sum(w * (2**58 - 1) for w in filter_audit.wide_counters("ABCDE")), "ABCDE").max() == 16 * (2**58 - 1)


# --- 12 ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_file())


@pytest.fixture(scope="module")
def model():
    with open(pieces.model_file(), "rb") as f:
        return pieces.Model(f.read())


def odd_texts(n):
    rng = random.Random(12)
    alphabet = list("abe thing  \n\t▁_.,;'0123456789éèß中文字😀́​�\x00\x01<>/") + ["<s>", "</s>", "<unk>", "<0x41>", "▁▁", "    ", "\r\n", "ﬁ", "①", "Ｈ"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(n)]
    return made + ["a" * 3000, "ab" * 2000 + "é" * 300, " " * 2000, "x" * 199, "x" * 200, "x" * 201, "the" * 500, "", " ", "▁"]


def test_pieces_and_spans_are_the_librarys(model, library):
    for t in odd_texts(2000) + [t or "" for t in texts()]:
        e = model.encode([t.encode()], ends=True)
        ids = e.ids.tolist()
        assert ids == library.encode(t, add_bos=True, add_eos=True), t
        assert model.decode(ids) == library.decode(ids), t
        want = [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]
        got = list(zip(e.starts.tolist(), e.ends.tolist(), strict=True))
        assert got[1:-1] == want and got[0] == (0, 0) and got[-1] == (len(t.encode()),) * 2, t
        # Whatever the ids are, the spans lay the text out from end to end.
        edges = [a for a, b in got[1:-1] if b > a] + [len(t.encode())]
        assert [b for a, b in got[1:-1] if b > a] == edges[1:] and edges[0] == 0


def test_decoding_any_ids(model, library):
    rng = random.Random(4)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 258), rng.randint(259, 31999), 28705]) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
def test_normalisation_through_compiled_maps(rule):
    """Longest prefix and alignment against the library's own normaliser, for its built-in maps."""
    import sentencepiece

    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = next(dict(pieces._fields(v)) for k, v in pieces._fields(theirs.serialized_model_proto()) if k == 3)
    mine = pieces.Normaliser(spec)
    assert bool(mine.map.units) == (rule != "identity")
    for t in odd_texts(1500):
        text, places = theirs.Normalize(t, with_offsets=True)
        got = mine(t.encode())
        assert got.text.replace(" ", "▁") == text, t
        if text:
            back = {int(p): i for i, p in enumerate(np.cumsum([0] + [len(c.encode()) for c in t]))}
            chars = np.cumsum([0] + [len(c.encode()) for c in got.text])
            assert [back[int(got.source[x])] for x in chars] == places, t


def test_bytes_that_are_no_text(model):
    """A bad byte is one U+FFFD whose pieces span that byte."""
    e = model.encode([b"a\xe4\xbdb\xff"])
    same = model.encode(["a��b�".encode()])
    assert e.ids.tolist() == same.ids.tolist() and model.decode(e.ids.tolist()) == "a��b�"
    spans = [(a, b) for a, b in zip(e.starts.tolist(), e.ends.tolist(), strict=True) if b > a]
    assert spans[0][0] == 0 and spans[-1][1] == 5 and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_piece_columns(spark, docs, none, rows, library):
    from pyspark.sql import functions as F

    shared = pieces.shared_model(spark)
    both = docs.withColumn("e", pieces.encoded(F.col("text"), shared)).withColumn("back", pieces.decoded(F.col("e.ids"), shared))
    got = both.withColumn("sum", pieces.digests(pieces.encoded(F.col("text"), shared, ends=True), shared)).collect()
    want = {(t or ""): library.encode(t or "", add_bos=True, add_eos=True) for _, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        ids = want[r.text or ""]
        assert r.e.ids == ids[1:-1] and r.back == library.decode(ids)
        assert r["sum"].n_tokens == len(ids) and r["sum"].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["sum"].decoded_sha256 == sha(library.decode(ids))
    assert none.select(pieces.encoded(F.col("text"), shared)).count() == 0


def test_other_models_are_refused(library):
    blob = library.serialized_model_proto()
    as_unigram = re.sub(rb"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01", blob, count=1)  # trainer: model type, vocabulary size
    assert as_unigram != blob
    with pytest.raises(ValueError, match="only BPE"):
        pieces.Model(as_unigram)


# --- 13 ---------------------------------------------------------------------------------------


def brute_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                out.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def test_runs_of_random_and_hard_sequences():
    rng = random.Random(13)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 250:
        fib.append(fib[-1] + fib[-2])
    cases = [fib[-1], [bin(i).count("1") & 1 for i in range(256)], [0] * 150, ([0, 1] * 20 + [0]) * 4, ([0, 1] * 20 + [0]) * 2, [], [1] * 11, [1] * 12]
    for _ in range(1500):
        w = [rng.randrange(rng.choice([1, 2, 2, 3, 20])) for _ in range(rng.randint(0, rng.choice([15, 40, 120])))]
        for _ in range(rng.randint(0, 4)):
            if w:
                a = rng.randrange(len(w))
                b = min(len(w), a + rng.randint(1, 30))
                w = w[:b] + w[a:b] * rng.randint(1, 6) + w[b:]
                if rng.random() < 0.4:
                    w[rng.randrange(len(w))] = rng.randrange(3)
        cases.append(w[:300])
    for w in cases:
        got = [x.tolist() for x in periodic_runs.periodic_runs(np.array(w, np.int32))]
        assert list(zip(*got, strict=True)) == brute_runs(w), w


def test_runs_make_few_seeds():
    """Pairs stay near-linear where every k-gram recurs everywhere."""
    n = 200_000
    for w in (np.zeros(n, np.int32), np.tile(np.array([0, 1], np.int32), n // 2)):
        levels = periodic_runs._levels(w)
        seeds = sum(len(periodic_runs._seeds(w, names, k, k, 2 * k)) for k, names in levels.items() if k >= 8)
        assert seeds < 2 * n
        assert [x.tolist() for x in periodic_runs.periodic_runs(w)] == [[0], [n], [int(w[1]) + 1]]


def brute_report(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (len(runs), *best, 1000 * best[1] // best[2]) if best else (0, None, None, None, None)
    return (*head, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_periodic_runs_query(spark, rows, tmp_table):
    path = tmp_table("runs")
    spark.createDataFrame([r for r in rows], "doc_id long, text string, lang string").write.parquet(f"{path}/documents.parquet")
    got = periodic_runs.op13_periodic_runs(spark, path)
    want = [(d, *brute_report(d, t)) for d, t, _ in rows]
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, ([r[c] for c in columns] for r in got.collect()))) == sorted(repr(list(x)) for x in want)
    assert sum(x[1] > 0 for x in want) >= 5 and max(x[1] for x in want) > 1


def test_runs_column(spark, docs, none, rows):
    from pyspark.sql import functions as F

    got = docs.withColumn("found", periodic_runs.with_runs(F.col("text"))).collect()
    for r in got:
        w = WORD.findall(r.text or "")
        assert [tuple(x) for x in r.found.runs] == brute_runs(w)
    spam = next(r for r in got if r.text == "spam " * 130)
    assert spam.found.collapsed == "spam"
    assert none.select(periodic_runs.with_runs(F.col("text"))).count() == 0
