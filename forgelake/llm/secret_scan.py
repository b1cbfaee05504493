"""Operator 2: secret scans (DataFrame functions only).

Base kinds are patterns.  On top of them every candidate string (a run of token
characters) gets a sliding window whose Shannon entropy is kept by incremental counts:
each step moves one character in and one out and changes the sum of c*log2(c) by their
terms alone.  Window and threshold depend on the candidate's character class (hex or
base64); candidates on the allow list, and those that touch a base span, add nothing.

Defined cases: a null or empty text has no spans and the digest of the empty string;
ids may be null or repeated (rows are scanned one by one); an empty table gives no rows;
other columns are ignored (``redact`` keeps them).  Positions are code points, the end
exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgelake.llm.common import free, table

#: The base kinds (the assign keyword ignores ASCII case).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # run and length in one: a run that is too short holds no longer match
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Candidates: whole runs of token characters that hold a letter and a digit.
RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE = rf"(?<!{RUN})(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z]){RUN}{{20,}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Character classes: (what the candidate matches, window, least entropy in bits); the first that matches holds.
CLASSES = (("^[0-9A-Fa-f]+$", 16, 2.9), (f"^{RUN}+$", 20, 3.85))
#: Allow list: UUIDs, dates, paths and slugs of plain words or numbers, placeholders, counting runs.
ALLOW = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[A-Za-z0-9_=-]*$",
    r"^/?([A-Za-z]+|[0-9]+)([/_=-]+([A-Za-z]+|[0-9]+))*/?$",
    r"(?i)example|sample|dummy|placeholder|changeme|redacted|xxxxxx",
    r"(?i)123456789|abcdefghij",
)
REPLACEMENT = "[SECRET]"

_MATCHES = "array<struct<s:int,e:int,m:string>>"


#: Elements that a fold appends one by one; longer arrays are folded in pieces, so the cost of appending stays near-linear.
PIECE = 256


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), 0)


def _pieces(items: Column) -> Column:
    cuts = F.sequence(F.lit(0), F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / PIECE).cast("int"))
    return F.transform(cuts, lambda c: F.slice(items, c * PIECE + 1, F.lit(PIECE)))


def _scan(items: Column, zero: Column, step, each, empty: str) -> Column:
    """Flattened ``each(piece, state before it)`` over the pieces of an array; ``step(state, item)`` carries the state on.

    ``empty``: type of the states' array.
    """

    def over(pieces: Column) -> Column:
        carried = F.aggregate(
            pieces,
            F.struct(zero.alias("state"), F.array().cast(empty).alias("before")),
            lambda acc, piece: F.struct(
                F.aggregate(piece, acc["state"], step).alias("state"), F.concat(acc["before"], F.array(acc["state"])).alias("before")
            ),
            lambda acc: acc["before"],
        )
        return F.flatten(F.zip_with(pieces, carried, each))

    return _bound(_pieces(items), over)


def _running(items: Column, zero: Column, step, emit, kind: str, empty: str) -> Column:
    """``emit(state before the item, item)`` of every item, an array of ``kind``."""

    def each(piece: Column, state: Column) -> Column:
        start = F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        add = lambda acc, x: F.struct(
            step(acc["state"], x).alias("state"), F.concat(acc["out"], F.array(emit(acc["state"], x))).alias("out")
        )
        return F.aggregate(piece, start, add, lambda acc: acc["out"])

    return _scan(items, zero, step, each, empty)


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches; the lengths of the gaps between them give the positions."""

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("n"), m.alias("m")))
        span = lambda at, x: F.struct((at + x["g"]).alias("s"), (at + x["g"] + x["n"]).alias("e"), x["m"].alias("m"))
        kind = _MATCHES.removeprefix("array<").removesuffix(">")
        return _running(pairs, F.lit(0), lambda at, x: at + x["g"] + x["n"], span, kind, "array<int>")

    none = F.array().cast(_MATCHES)
    return F.when(text.rlike(pattern), _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(none)


def _apart(spans: Column, base: Column) -> Column:
    """Those of ``spans`` that overlap none of ``base``: one pass each way over both, in order."""
    mark = lambda xs, k: F.transform(xs, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("new"), x["e"].alias("e")))
    kind = "struct<s:int,new:int,e:int>"
    # From the left: the furthest end of a base span so far; from the right: the nearest start of one.
    reach = lambda at, x: F.when(x["new"] == 0, F.greatest(at, x["e"])).otherwise(at)
    clear = lambda at, x: F.struct(x["s"].alias("s"), F.when((x["new"] == 1) & (at > x["s"]), 2).otherwise(x["new"]).alias("new"), x["e"].alias("e"))
    nearest = lambda at, x: F.when(x["new"] == 0, F.least(at, x["s"])).otherwise(at)
    free_on_right = lambda at, x: F.struct(x["s"].alias("s"), F.when((x["new"] == 1) & (at < x["e"]), 2).otherwise(x["new"]).alias("new"), x["e"].alias("e"))
    both = F.array_sort(F.concat(mark(base, 0), mark(spans, 1)))
    left = _running(both, F.lit(0), reach, clear, kind, "array<int>")
    right = _running(F.reverse(left), F.lit((1 << 31) - 1), nearest, free_on_right, kind, "array<int>")
    return F.transform(F.filter(right, lambda x: x["new"] == 1), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


def _high_windows(candidate: Column, window: int, least: float) -> Column:
    """struct(first, last): ends of the first and last window of enough entropy in the candidate (0: none)."""
    chars = F.filter(F.split(candidate, ""), lambda c: c != "")
    place = lambda c: F.position(c, F.lit(ALPHABET))
    moves = F.transform(
        chars,
        lambda c, i: F.struct(
            place(c).alias("enter"),
            F.when(i >= window, place(F.get(chars, i - window))).otherwise(0).alias("leave"),
            (i + 1).alias("at"),
        ),
    )
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("first"), F.lit(0).alias("last")
    )

    def term(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c)).otherwise(0.0)

    def enter_leave(acc: Column, x: Column) -> Column:
        same = x["enter"] == x["leave"]
        come = F.element_at(acc["counts"], x["enter"])
        go = F.element_at(acc["counts"], F.greatest(x["leave"], F.lit(1)))
        change = term(come + 1) - term(come) + F.when(x["leave"] > 0, term(go - 1) - term(go)).otherwise(0.0)
        moved = F.transform(
            acc["counts"], lambda v, k: v + (k + 1 == x["enter"]).cast("int") - (k + 1 == x["leave"]).cast("int")
        )
        return F.struct(
            F.when(same, acc["counts"]).otherwise(moved).alias("counts"),
            (acc["sum"] + F.when(same, 0.0).otherwise(change)).alias("sum"),
            acc["first"].alias("first"),
            acc["last"].alias("last"),
        )

    def mark(acc: Column, x: Column) -> Column:
        high = (x["at"] >= window) & (F.lit(math.log2(window)) - acc["sum"] / window >= least)
        return F.struct(
            acc["counts"].alias("counts"),
            acc["sum"].alias("sum"),
            F.when(high & (acc["first"] == 0), x["at"]).otherwise(acc["first"]).alias("first"),
            F.when(high, x["at"]).otherwise(acc["last"]).alias("last"),
        )

    def step(acc: Column, x: Column) -> Column:
        # The inner fold over one element binds the new counts, so they are computed once.
        return F.aggregate(F.array(x), acc, lambda a, y: enter_leave(a, y), lambda a: mark(a, x))

    return F.aggregate(moves, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _placed(start: Column, window: int):
    """From ends of windows in a candidate to a span of the text."""
    return lambda w: F.struct((start + w["first"] - window).alias("s"), (start + w["last"]).alias("e"))


def _entropy(candidates: Column) -> Column:
    """array<struct<s,e>>: from the first to the last high window of each candidate."""

    def spans(c: Column) -> Column:
        out = F.array().cast("array<struct<s:int,e:int>>")
        for matched, window, least in reversed(CLASSES):
            found = F.transform(
                F.filter(F.array(_high_windows(c["m"], window, least)), lambda w: w["last"] > 0), _placed(c["s"], window)
            )
            out = F.when(c["m"].rlike(matched), found).otherwise(out)
        return out

    # Java matches a repeated group by recursion unless it is possessive; the parts of a slug match in one way only.
    allow = "|".join(f"(?:{a.replace('))*', '))*+')})" for a in ALLOW)
    allowed = lambda c: F.lit(False) if not ALLOW else c["m"].rlike(allow)
    return F.flatten(F.transform(F.filter(candidates, lambda c: ~allowed(c)), spans))


def with_spans(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """``docs`` with ``into``: array<struct<s, kind, e>> of all spans, by start, then kind (its place in KINDS)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    as_kind = lambda spans, k: F.transform(
        spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("kind"), x["e"].alias("e"))
    )
    assign = F.filter(_matches(t, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_LEAST)
    base = F.concat(as_kind(assign, 0), as_kind(_matches(t, ACCESS), 1), as_kind(_matches(t, HEX), 2))
    also = free(f"{into}__more", docs)
    found = docs.withColumn(into, base).withColumn(also, _matches(t, CANDIDATE))
    more = F.when(F.size(also) > 0, _entropy(F.col(also))).otherwise(F.array().cast("array<struct<s:int,e:int>>"))
    found = found.withColumn(also, more)
    clear = F.when(F.size(also) > 0, _apart(F.col(also), F.col(into))).otherwise(F.col(also))
    return found.withColumn(into, F.array_sort(F.concat(into, as_kind(clear, 3)))).drop(also)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"], x["e"])), ",")


def redact(docs: DataFrame, replacement: str = REPLACEMENT) -> DataFrame:
    """``docs`` with each run of spans replaced in the text and n_chars (where there is one) counted anew."""
    spans = free("__spans", docs)
    found = with_spans(docs, into=spans)
    text = F.col("text")
    further = lambda at, x: F.greatest(at, x["e"])

    def each(piece: Column, at: Column) -> Column:
        """Kept texts and replacements of a piece's spans, cut from the part of the text that they lie in."""
        part = F.substring(text, at + 1, F.greatest(F.array_max(F.transform(piece, lambda x: x["e"])) - at, F.lit(0)))

        def cut(own: Column) -> Column:
            start = F.struct(at.alias("at"), F.array().cast("array<string>").alias("out"))
            add = lambda acc, x: F.struct(
                further(acc["at"], x).alias("at"),
                F.when(
                    x["s"] >= acc["at"],
                    F.concat(acc["out"], F.array(F.substring(own, acc["at"] - at + 1, x["s"] - acc["at"]), F.lit(replacement))),
                )
                .otherwise(acc["out"])
                .alias("out"),
            )
            return F.aggregate(piece, start, add, lambda acc: acc["out"])

        return _bound(part, cut)

    last = F.array_max(F.transform(spans, lambda x: x["e"]))
    parts = _scan(F.col(spans), F.lit(0), further, each, "array<int>")
    whole = F.concat(F.array_join(parts, ""), F.substring(text, last + 1, F.length(text)))
    clean = found.withColumn("text", F.when(F.size(spans) > 0, whole).otherwise(text))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_secret_scan(spark, sf_dir):
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    base = joined(F.filter("spans", lambda x: x["kind"] < 3))
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(base, 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _oracle() -> str:
    def matches(name: str, pattern: str) -> str:
        quoted = pattern.replace("'", "''")
        return f"""
  SELECT rid, i, g, m, (sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m))::BIGINT AS s
  FROM (SELECT rid, unnest(range(1, len(m) + 1)) AS i, unnest(g[:len(m)]) AS g, unnest(m) AS m
        FROM (SELECT rid, string_split_regex(t, '{quoted}') AS g, regexp_extract_all(t, '{quoted}') AS m FROM d))"""

    fold = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
    assign = ASSIGN.replace("(?i:(password|passwd|secret|token|api_?key))", "KEY")
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join([fold, either("passwd"), either("secret"), either("token"), either("api") + "_?" + either("key")])
    assign = assign.replace("KEY", f"(?:{words})")
    value = "length(regexp_extract(m, '" + assign.replace("'", "''") + "', 1))"
    allow = "|".join(f"(?:{a.removeprefix('(?i)')})" if not a.startswith("(?i)") else f"(?i:{a[4:]})" for a in ALLOW)
    (hex_rx, hex_w, hex_h), (_, b_w, b_h) = CLASSES
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
a AS ({matches("a", assign)}), k AS ({matches("k", ACCESS)}), h AS ({matches("h", HEX)}),
c AS ({matches("c", RUN + "{20,}")}),
base AS (
  SELECT rid, s, 0 AS kind, s + length(m) AS e FROM a WHERE {value} >= {ASSIGN_LEAST}
  UNION ALL SELECT rid, s, 1, s + length(m) FROM k UNION ALL SELECT rid, s, 2, s + length(m) FROM h
),
w AS (
  SELECT rid, s, m, CASE WHEN regexp_matches(m, '{hex_rx}') THEN {hex_w} ELSE {b_w} END AS n,
         CASE WHEN regexp_matches(m, '{hex_rx}') THEN {hex_h} ELSE {b_h} END AS least
  FROM c WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND NOT regexp_matches(m, '{allow}')
),
v AS (SELECT rid, s, n, least, m, unnest(range(n, length(m) + 1)) AS p FROM w),
hits AS (
  SELECT rid, min(v.s + p - n) AS s, max(v.s + p) AS e FROM v
  WHERE list_entropy(string_split(m[p - n + 1:p], '')) >= least GROUP BY rid, v.s, m
),
spans AS (
  SELECT * FROM base UNION ALL
  SELECT rid, s, 3, e FROM hits WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = hits.rid AND b.s < hits.e AND hits.s < b.e)
),
named AS (SELECT *, concat_ws(':', ['assign', 'access', 'hex', 'entropy'][kind + 1], s, e) AS x FROM spans)
SELECT any_value(doc_id) AS doc_id,
       count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(x, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(x, ',' ORDER BY s, kind), '') AS spans
FROM d LEFT JOIN named USING (rid) GROUP BY rid
"""


ORACLE_SQL = _oracle()
