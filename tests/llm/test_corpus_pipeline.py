"""The chain of corpus_pipeline, each stage and the whole, against brute force on a small table."""

from __future__ import annotations

import contextlib
import hashlib
import io
import math
import random
import re
from collections import Counter

import pytest
from test_operators import WORD, brute_links, brute_spans, words

import corpus_pipeline as chain
from forgelake.llm import packing, secret_scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


PREFIXED = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")


def made():
    rng = random.Random(21)
    texts = [words(rng, rng.randint(20, 80)) for _ in range(60)]
    texts += [texts[3], texts[3] + " end", texts[4].upper(), " ".join(texts[5].split()[:-1])]
    texts += [words(rng, 30) + " key q7Zp0Lx9Vb3Nk5Tg8Wd2Rf6Yh4Jc1Ms password = Sup3rS3cretValue99" for _ in range(2)]
    texts += ["vile scum filth " * 12 + words(rng, 3) for _ in range(30)] + [None, "", " \n"]
    rows = [(i, t, "en", ("s1", "s2", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, int("vile" in (t or "")), 1) for i, t in enumerate(texts)]
    return rows, labels


def clean(rows):
    return [r for r in rows if "vile" not in (r[1] or "")]


def deduplicated(rows):
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    roots = brute_links([r[0] for r in rows], linked)
    return [r for r, root in zip(rows, roots, strict=True) if r[0] == root]


def redacted(rows):
    out = []
    for r in rows:
        text, at, parts = r[1] or "", 0, []
        spans = brute_spans(r[1])
        for s, _, e in spans:
            if s >= at:
                parts += [text[at:s], secret_scan.REPLACEMENT]
            at = max(at, e)
        new = "".join(parts) + text[at:] if spans else r[1]
        out.append((*r[:1], new, *r[2:4], len(new) if spans else r[4]))
    return out


def mixed(rows):
    size = {r: len(WORD.findall(r[1] or "")) for r in rows}
    keys = sorted({r[3] for r in rows if r[3]}) + [None]
    total = {k: sum(size[r] for r in rows if r[3] == k) for k in keys}
    left, weight, target = 1.5 * sum(total.values()), {k: (3, 1, 2)[i % 3] for i, k in enumerate(keys)}, {}
    while weight:
        level = left / sum(weight.values())
        full = [k for k in weight if level * weight[k] > 2 * total[k]]
        target |= {k: 2.0 * total[k] for k in full} if full else {k: level * w for k, w in weight.items()}
        left -= sum(2.0 * total[k] for k in full)
        weight = {k: w for k, w in weight.items() if k not in full} if full else {}
    out = []
    for k in keys:
        take, start = math.floor(target[k] + 0.5), 0
        for r in sorted((r for r in rows if r[3] == k), key=lambda r: hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()):
            n = size[r]
            taken = take // total[k] * n + max(0, min(start + n, take % total[k]) - start)
            start += n
            if n:
                out += [r] * (taken // n)
                if taken % n:
                    text = "".join(PREFIXED.findall(r[1])[: taken % n])
                    out.append((*r[:1], text, *r[2:4], len(text)))
    return out


@pytest.fixture(scope="module")
def corpus_dir(spark, tmp_path_factory):
    rows, labels = made()
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_and_run(spark, corpus_dir):
    from tokenizers import Tokenizer

    rows, _ = made()
    assert [name for name, _ in chain.STAGES] == ["toxicity", "n-gram Jaccard join", "secret scans", "mixing sources", "packing"]
    for (name, stage), brute in zip(chain.STAGES, (clean, deduplicated, redacted, mixed), strict=False):
        before, want = rows, brute(rows)
        got = stage(spark, spark.createDataFrame(before, SCHEMA).repartition(3), corpus_dir)
        assert got.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", "), name
        assert Counter(map(tuple, got.collect())) == Counter(want), name
        assert want != before, name  # the stage has something to do
        rows = want
    whole = Tokenizer.from_file(packing.tokenizer_file())
    tokens = Counter()
    for r in rows:
        tokens[r[0]] += len(whole.encode(r[1] or "", add_special_tokens=False).ids) + 1
    for packed in (chain.STAGES[-1][1](spark, spark.createDataFrame(rows, SCHEMA), corpus_dir), chain.run(spark, corpus_dir)):
        packed = packed.collect()
        pieces = Counter()
        for p in packed:
            pieces[p.doc_id] += p.length
        assert pieces == tokens
        length = Counter()
        for p in sorted(packed, key=lambda p: (p.sequence_id, p.offset)):
            assert length[p.sequence_id] == p.offset
            length[p.sequence_id] += p.length
        assert max(length.values()) <= 4096


EXTRA = ["__score", "__spans", "__spans__more", "__id", "__node", "__key", "__size", "__times", "__copy", "score", "spans", "node", "root", "label", "n", "a.b"]


def test_stages_keep_columns_of_any_name(spark, corpus_dir):
    """Names that a stage might use itself stay the user's, values included."""
    rows, _ = made()
    kinds = ", ".join(f"`{c}` string" for c in EXTRA)
    for name, stage in chain.STAGES[:-1]:
        plain = stage(spark, spark.createDataFrame(rows, SCHEMA), corpus_dir)
        wide = spark.createDataFrame([(*r, *(f"{c} of {r[0]}" for c in EXTRA)) for r in rows], f"{SCHEMA}, {kinds}")
        got = stage(spark, wide, corpus_dir)
        assert got.columns == wide.columns, name
        got = got.collect()
        assert Counter(tuple(r)[:5] for r in got) == Counter(map(tuple, plain.collect())), name
        assert all(tuple(r)[5:] == tuple(f"{c} of {r.doc_id}" for c in EXTRA) for r in got), name
    assert chain.STAGES[-1][1](spark, wide, corpus_dir).count() > 0


def test_a_source_of_one_long_document_is_cut_not_lost(spark):
    rows = [(1, "a b\n c  d e f", "en", "long", 12), (2, "w " * 40, "en", "other", 80), (3, "x " * 40, "en", "other", 80)]
    mixed_rows = chain.mix_sources(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert Counter(map(tuple, mixed_rows)) == Counter(mixed(rows))
    # 129 words in all: a source of weight 1 gets its target to the word
    words_of = Counter()
    for r in mixed_rows:
        words_of[r.source] += len(WORD.findall(r.text))
    assert words_of == {"long": 12, "other": 117}


def test_texts_are_named_once_to_leave_out_copies(spark):
    """Each further naming reads all texts again, in a Python worker more per task that later stages find still there."""
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (2, "A b c d e f", "en", "s", 11), (3, "g h i j k l", "en", "s", 11)]
    blank = [(4, None, "en", "s", 0), (4, None, "en", "s", 0), (1, " ", "en", "s", 1), (None, "", "en", "s", 0), (None, "", "en", "s", 0)]
    blank += [(i, "", "en", "s", 0) for i in range(3)]
    got = chain.drop_near_duplicates(spark, spark.createDataFrame(rows + blank, SCHEMA).repartition(3), "")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain()
    assert out.getvalue().count("ArrowEvalPython") == 1
    assert Counter(map(tuple, got.collect())) == Counter([rows[0], rows[3], *blank])
