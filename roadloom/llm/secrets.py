"""Secret scans with multipart credential linking, in DataFrame functions only.

Base kinds are found in every whole text by regular expressions, leftmost and without overlap in each kind. Weak
candidates (user names, endpoints, short assignments, short hexadecimal runs, forty-character keys) count only when a
complementary part lies in their scope: an interval join on (row, cell of SCOPE code points) keeps a weak part if the
gap to a complementary part is at most SCOPE. Access identifiers and endpoints complement secrets, secrets complement
both. A cell holds at most SCOPE code points, so the join's work is bounded and grows with the text alone; it is a
semi join and makes no pairs.

Positions are code points, ends exclusive. Defined cases: null text is an empty text; a text without findings has
counts 0, empty spans and the hash of the empty string; repeated rows each give a row; rows that share a doc_id but
not the text are scanned apart; null doc_ids stay; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_rows

#: Code points between two parts that belong together, at most.
SCOPE = 200
#: Elements of an array that are folded at a time, and code points of a text that are cut at a time.
CHUNK, STRIDE = 128, 8192

# Patterns of the base kinds, then of the weak ones.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
USER = r"""(?i:(user|username|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
ENDPOINT = r"""(?i:https?|s?ftp|postgres|postgresql|mysql|mongodb|redis|amqps?|s3|ssh)://[A-Za-z0-9_.:/?&=%@+-]{4,}"""
SHORT_HEX = r"(?<![0-9A-Za-z])[0-9a-f]{16,23}(?![0-9A-Za-z])"
KEY40 = r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{0,39}[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"

#: Kind, its rank in joined spans, its role: (a)ccess, (s)ecret or (e)ndpoint.
KINDS = [("assign", 0, "s"), ("access", 1, "a"), ("hex", 2, "s"), ("user", 3, "a"), ("endpoint", 4, "e"), ("short", 5, "s"), ("shorthex", 6, "s"), ("key40", 7, "s")]
_RANK = {k: (r, role) for k, r, role in KINDS}
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,role:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _chunks(values: Column, size: int) -> Column:
    """The array in pieces of at most ``size``."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / size).cast("int")), lambda c: F.slice(values, c * size + 1, size))


def _placed(parts: Column, at: Column) -> Column:
    """Spans of matches from (gap, len) pairs, the first gap beginning at ``at``; the result grows by copying, so pieces are short."""
    empty = F.struct(at.alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    return F.aggregate(
        parts,
        empty,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["len"]).alias("end")))).alias("spans"),
        ),
    )["spans"]


def _starts(sizes: Column) -> Column:
    """Running sums before each element; quadratic, for short arrays."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all"))
    return F.aggregate(sizes, zero, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")))["all"]


def _found(text: Column, pattern: str) -> Column:
    """Spans (start, end) of the pattern's matches, in order.

    The pieces between matches and the matches themselves alternate, so that their lengths add up to positions. Many
    matches are added up in pieces of CHUNK, whose starts are added up in turn, twice.
    """
    m = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(m, F.slice(F.split(text, pattern, -1), 1, F.size(m)), lambda a, b: F.struct(F.length(b).cast("long").alias("gap"), F.length(a).cast("long").alias("len")))
    zero = F.lit(0).cast("long")
    total = lambda ps: F.aggregate(ps, zero, lambda acc, x: acc + x["gap"] + x["len"])

    def by_chunks(chunks: Column) -> Column:
        def at_both(sums: Column) -> Column:
            of_wide = lambda w: F.aggregate(w, zero, lambda acc, x: acc + x)
            wide = _chunks(sums, CHUNK)
            inner = F.zip_with(wide, _starts(F.transform(wide, of_wide)), lambda w, at: F.transform(_starts(w), lambda x: x + at))
            return F.flatten(F.zip_with(chunks, F.flatten(inner), _placed))

        return _let(F.transform(chunks, total), at_both)

    spans = _let(parts, lambda p: F.when(F.size(p) <= CHUNK, _placed(p, zero)).otherwise(_let(_chunks(p, CHUNK), by_chunks)))
    return F.when(F.size(m) > 0, spans).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def _kind(spans: Column, kind: str) -> Column:
    rank, role = _RANK[kind]
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(role).alias("role")))


def _of_pattern(text: Column, pattern: str, kind: str) -> Column:
    none = F.array().cast(SPAN)
    return F.when(F.rlike(text, F.lit(pattern)), _kind(_found(text, pattern), kind)).otherwise(none)


def _assigned(text: Column) -> Column:
    """Assignments; those whose value has fewer than six characters are the weak kind ``short``."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    both = F.zip_with(
        _found(text, ASSIGN),
        values,
        lambda s, v: F.struct(
            s["start"].alias("start"), F.when(F.length(v) >= 6, F.lit(0)).otherwise(F.lit(_RANK["short"][0])).alias("rank"), s["end"].alias("end"),
            F.when(F.length(v) >= 6, F.lit("assign")).otherwise(F.lit("short")).alias("kind"), F.lit("s").alias("role"),
        ),
    )
    return F.when(F.rlike(text, F.lit(ASSIGN)), both).otherwise(F.array().cast(SPAN))


def _split(spans: Column) -> Column:
    """A struct of base spans, sorted, and weak parts; weak secrets that overlap a base span are dropped."""
    is_base = lambda x: x["rank"] <= _RANK["hex"][0]

    def apart_from(base: Column, weak: Column) -> Column:
        meets = lambda b, w: (b["start"] < w["end"]) & (w["start"] < b["end"])

        def kept(chunks: Column) -> Column:
            hit = lambda w: F.exists(chunks, lambda c: meets(c, w) & F.exists(c["spans"], lambda b: meets(b, w)))
            return F.filter(weak, lambda w: (w["role"] != "s") | ~hit(w))

        bounds = lambda c: F.struct(F.array_min(F.transform(c, lambda b: b["start"])).alias("start"), F.array_max(F.transform(c, lambda b: b["end"])).alias("end"), c.alias("spans"))
        return F.when((F.size(base) == 0) | (F.size(weak) == 0), weak).otherwise(_let(F.transform(_chunks(base, CHUNK), bounds), kept))

    both = lambda s: F.struct(F.array_sort(F.filter(s, is_base)).alias("base"), F.filter(s, lambda w: ~is_base(w)).alias("weak"))
    return _let(spans, lambda s: _let(both(s), lambda x: F.struct(x["base"].alias("base"), apart_from(x["base"], x["weak"]).alias("weak"))))


def parts(rows: DataFrame) -> DataFrame:
    """``rows`` (with doc_id and text) and the row's key ``k1``, ``k2``, its ``base`` spans and ``weak`` parts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = [_assigned(text)] + [_of_pattern(text, p, k) for p, k in ((ACCESS, "access"), (HEX, "hex"), (USER, "user"), (ENDPOINT, "endpoint"), (SHORT_HEX, "shorthex"), (KEY40, "key40"))]
    out = rows.withColumns({"k1": F.xxhash64("doc_id", text), "k2": F.xxhash64(text, F.lit(17)), "base_weak": _split(F.concat(*spans))})
    return out.select(*rows.columns, "k1", "k2", "base_weak.base", "base_weak.weak")


def link(found: DataFrame) -> DataFrame:
    """k1, k2 and ``linked``: the weak parts with a complementary part in scope, by interval join; rows without are left out."""
    rows = found.filter(F.size("weak") > 0).select("k1", "k2", "base", "weak").dropDuplicates(["k1", "k2"])
    weak = rows.select("k1", "k2", F.explode("weak").alias("w"))
    near = rows.select("k1", "k2", F.explode(F.concat("base", "weak")).alias("c"))
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / SCOPE), F.floor(b / SCOPE)))
    weak = weak.withColumn("cell", cells(F.col("w.start"), F.col("w.end"))).alias("l")
    near = near.withColumn("cell", cells(F.col("c.start") - SCOPE, F.col("c.end") + SCOPE)).alias("r")
    l, r = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    meets = (l("k1") == r("k1")) & (l("k2") == r("k2")) & (l("cell") == r("cell"))
    meets &= (r("c.start") - l("w.end") <= SCOPE) & (l("w.start") - r("c.end") <= SCOPE)
    meets &= F.when(l("w.role") == "s", r("c.role") != "s").otherwise(r("c.role") == "s")
    return weak.join(near, meets, "left_semi").groupBy("k1", "k2").agg(F.array_sort(F.collect_set("w")).alias("linked"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base kinds, hash of the base spans, all spans and how many were linked."""
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.cut(parts(text_rows(docs)).select("doc_id", "k1", "k2", "base", "weak"))
    none = F.array().cast(SPAN)
    out = found.select("doc_id", "k1", "k2", "base").join(link(found), ["k1", "k2"], "left").withColumn("linked", F.coalesce("linked", none))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "linked"))).alias("spans"), F.size("linked").cast("long").alias("n_linked"),
    )


def _pieces(text: Column):
    """The text's strides, and a function that joins the part from a to b of them, so that no cut runs through the whole text."""
    strides = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / STRIDE).cast("int")), lambda c: F.substring(text, c * STRIDE + 1, F.lit(STRIDE)))

    def of(cut: Column, a: Column, b: Column) -> Column:
        first, last = F.floor(a / STRIDE).cast("int"), F.floor(b / STRIDE).cast("int")
        part = lambda c: F.substring(F.get(cut, c), F.greatest(a - c * STRIDE, F.lit(0)).cast("int") + 1, (F.least(b, (c + 1) * STRIDE) - F.greatest(a, c * STRIDE)).cast("int"))
        return F.when(a < b, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise(F.lit(""))

    return strides, of


def _covered(spans: Column) -> Column:
    """The furthest end before each span, 0 for the first."""
    top = lambda s, least: F.aggregate(s, F.struct(least.alias("at"), F.array().cast("array<bigint>").alias("all")), lambda acc, x: F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")))
    zero = F.lit(0).cast("long")

    def by_chunks(chunks: Column) -> Column:
        ends = F.transform(chunks, lambda c: F.struct(F.array_max(F.transform(c, lambda x: x["end"])).alias("end")))
        return F.flatten(F.zip_with(chunks, top(ends, zero)["all"], lambda c, at: top(c, at)["all"]))

    return F.when(F.size(spans) <= CHUNK, top(spans, zero)["all"]).otherwise(_let(_chunks(spans, CHUNK), by_chunks))


def _masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by a mark of its kind; a span that starts inside an earlier one adds nothing."""
    strides, piece = _pieces(text)

    def joined(cut: Column) -> Column:
        marked = lambda x, at: F.when(x["start"] >= at, F.concat(piece(cut, at, x["start"]), F.lit("<"), x["kind"], F.lit(">"))).otherwise(F.lit(""))
        furthest = F.array_max(F.transform(spans, lambda x: x["end"]))
        return F.concat(F.array_join(F.zip_with(spans, _covered(spans), marked), ""), piece(cut, furthest, F.length(text).cast("long")))

    return F.when(F.size(spans) > 0, _let(strides, joined)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with their own columns; base and linked spans of the text are masked and n_chars, if there, recounted.

    Rows whose parts can't link (no weak part, or no complementary role in the row) are masked where they are; only the
    others take part in the interval join, so that whole texts are not shuffled for its sake.
    """
    own = docs.columns
    taken = {"k1", "k2", "base_weak", "base", "weak", "linked", "spans"} & set(own)
    names = {c: f"_own_{i}" for i, c in enumerate(own) if c in taken}
    rows = docs.withColumnsRenamed(names) if names else docs
    # written once: filters on the spans would otherwise run every pattern again in each branch
    rows = Scratch(docs.sparkSession, "secrets").cut(parts(rows.withColumn("text", F.col("text").cast("string"))))
    role = lambda c, r: F.exists(c, lambda x: x["role"] == r)
    every = F.concat("base", "weak")
    can_link = (F.size("weak") > 0) & role(every, "s") & (role(every, "a") | role(every, "e"))
    plain = rows.filter(~can_link).withColumn("spans", F.col("base"))
    linking = rows.filter(can_link)
    linked = linking.join(link(linking), ["k1", "k2"], "left").withColumn("spans", F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(SPAN)))))
    out = plain.select(*rows.columns, "spans").unionByName(linked.select(*rows.columns, "spans"))
    out = out.withColumn("text", _masked(F.col("text"), F.col("spans")))
    if "n_chars" in own and "n_chars" not in names:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in own])
