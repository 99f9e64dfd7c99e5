"""Document fingerprints by one-permutation MinHash.

A document's shingles (``SHINGLE`` words, joined by their hashes) are hashed once. The
top bits of a hash name one of ``bins`` bins, and a bin keeps its least hash. An
empty bin k borrows from the first non-empty bin of a probe order of its own (optimal
densification: p(k, 1), p(k, 2), ... by a hash; after PROBES misses the non-empty bins in
the order of a hash of k and the bin), so two documents with the same non-empty bins borrow alike. Stored are the
low ``bits`` bits of every bin's value, hashed again with the bin, as lowercase hex. Two
unequal values agree in them by chance once in 2^bits, which :func:`likeness` takes out.

Everything is DataFrame operations and SQL functions. A text is split, hashed and
binned within its row; only the order of the documents needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.llm.common import stage

#: Words in a shingle; a text of fewer words is one shingle.
SHINGLE = 5
#: Bins (a power of two) and stored bits of each (8 or 16).
BINS, BITS = 256, 8
#: Probes by a hash before an empty bin looks at all the non-empty ones.
PROBES = 16
#: Text bytes in a range of neighbouring documents, about, and the most ranges.
RANGE_BYTES = 16_000_000
MOST_RANGES = 100_000

_SPACE = r" \u0009\u000A\u000B\u000C\u000D"


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def fingerprint(text: str, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> Column:
    """The fingerprint of the column ``text``: ``bins * bits / 4`` hex digits.

    Words are runs of anything but ASCII white space, lower-cased. A null text is an
    empty one; a text without words has the fingerprint ''. Repeated shingles count once.
    """
    if bins < 2 or bins & (bins - 1) or bits not in (8, 16):
        raise ValueError("bins: a power of two from 2; bits: 8 or 16")
    low = 64 - (bins.bit_length() - 1)  # bits of a hash below its bin
    words = "if(t = '', cast(array() as array<string>), split(t, '[\\\\x09-\\\\x0D\\\\x20]+'))"
    several = ", ".join(f"h[i + {j}]" if j else "h[i]" for j in range(shingle))
    # Hashes are even; the odd end marks, the last number of every bin, sort behind the bin's hashes.
    some = (f"if(size(h) < {shingle}, array(xxhash64(h) & -2L), "
            f"transform(sequence(0, size(h) - {shingle}), i -> xxhash64({several}) & -2L))")
    marks = f"transform(sequence({-bins // 2}L, {bins // 2 - 1}L), k -> (shiftleft(k, {low}) | {2 ** low - 1}L))"
    least = "filter(s, (x, i) -> i = 0 or s[i - 1] & 1L = 1L)"
    full = f"transform({least}, x -> if(x & 1L = 1L, null, x))"
    probes = ", ".join(f"d[cast(xxhash64(k, {t}) & {bins - 1}L as int)]" for t in range(1, PROBES + 1))
    last = f"array_min(transform(f, y -> struct(xxhash64(k, shiftright(y, {low})) as o, y))).y"
    stored = f"lpad(hex(xxhash64(coalesce(x, {probes}, {last}), k) & {2 ** bits - 1}L), {bits // 4}, '0')"
    body = f"lower(array_join(transform(d, (x, k) -> {stored}), ''))"
    body = _let("d", full, _let("f", "filter(d, x -> x is not null)", body))
    body = _let("s", f"sort_array(concat({some}, {marks}))", body)
    body = _let("h", "transform(w, x -> xxhash64(x))", body)
    body = _let("w", words, f"if(size(w) = 0, '', {body})")
    return F.expr(_let("t", f"btrim(lower(coalesce({text}, '')), '{_SPACE}')", body))


def likeness(a: str, b: str, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two fingerprint columns' shingle sets.

    The share of equal bins less the share expected by chance, 2^-bits. Two empty
    fingerprints have 1, an empty and another 0, a null one null.
    """
    size = bits // 8
    same = (f"size(filter(sequence(0, {bins - 1}), k -> "
            f"substring(u, k * {size} + 1, {size}) = substring(v, k * {size} + 1, {size})))")
    exact = f"({same} * {2.0 ** bits}D - {bins}) / ({bins} * {2.0 ** bits - 1}D)"
    body = f"case when {a} = {b} then 1D when {a} = '' or {b} = '' then 0D else greatest(0D, least(1D, {exact})) end"
    return F.expr(_let("u", f"unhex({a})", _let("v", f"unhex({b})", body)))


# --- neighbours ---------------------------------------------------------------


def _part(h: str, m: str) -> str:
    """SQL: which of ``m`` equal parts of the hashes ``h`` is in, from 0."""
    return f"cast(least({m} - 1, floor(({h} / {2.0 ** 64}D + 0.5D) * {m})) as int)"


def ranged(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows(id, text)`` plus ``h`` (a hash of the text) and ``part``, and whether an id is frequent.

    Parts are ranges of (id, h) in ascending order, nulls first, of about RANGE_BYTES text bytes.
    Their bounds are quantiles of the ids; an id that is several quantiles has parts of its own,
    by equal ranges of h, so a frequent or null id is spread over as many tasks as its
    rows ask for.
    """
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n"),
                    F.count("id").alias("ids")).first()
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = min(MOST_RANGES, max(4 * shuffles, -(-(size.b or 0) // RANGE_BYTES)))
    nulls = max(1, many * (size.n - size.ids) // max(1, size.n))
    named = max(1, many - nulls)
    at = [k / named for k in range(1, named)]
    cuts = rows.agg(F.percentile_approx("id", at, 10 * named)).first()[0] if at else []
    ids = sorted(set(cuts or []))
    times = {i: 0 for i in ids}
    for i in cuts or []:
        times[i] += 1
    # Parts in order: nulls, below the first cut, then for each cut its own (if frequent) and those above it.
    own, above, k = [], [], nulls + 1
    for i in ids:
        own.append(k)
        k += times[i] if times[i] > 1 else 0
        above.append(k)
        k += 1
    with_h = rows.withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    null_part = _part("h", str(nulls))
    if ids:
        lists = {"cut": [F.lit(i).cast("long") for i in ids], "times": [F.lit(times[i]) for i in ids],
                 "own": [F.lit(p) for p in own], "above": [F.lit(p) for p in above]}
        tables = F.struct(*(F.array(*v).alias(n) for n, v in lists.items()))
        steps = ", ".join(str(2 ** s) for s in reversed(range(len(ids).bit_length())))
        # The number of cuts that are not above the id, by binary search.
        found = f"aggregate(array({steps}), 0, (lo, s) -> if(get(_t.cut, lo + s - 1) <= id, lo + s, lo))"
        hot = f"_t.own[i - 1] + {_part('h', '_t.times[i - 1]')}"
        named_part = _let("i", found, f"case when i = 0 then {nulls} when _t.cut[i - 1] = id and _t.times[i - 1] > 1 "
                                      f"then {hot} else _t.above[i - 1] end")
        with_h = with_h.withColumn("_t", tables)
    else:
        named_part = str(nulls)
    parts = with_h.withColumn("part", F.expr(f"if(id is null, {null_part}, {named_part})"))
    return parts.select("id", "text", "h", "part"), nulls > 1 or any(t > 1 for t in times.values())


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, fingerprint, next_text, next_fingerprint, times)``: every document and the next.

    Next is by ascending id, nulls first, then by a hash of the text, then by the text; after the last comes the
    first. Rows with the same id and text follow one another: where an id is frequent, they
    come as one row that stands for ``times`` rows; else each is a row (``times`` is 1).
    Null texts are empty. One table is written: the first row of each part.

    A row travels once, to the part of its neighbours; the first row of a part
    travels also to the part before it.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts, frequent = ranged(rows)
    if frequent:
        parts = parts.groupBy("id", "text", "h", "part").agg(F.count(F.lit(1)).alias("times"))
    else:
        parts = parts.withColumn("times", F.lit(1).cast("long"))
    # At most MOST_RANGES and as many rows again: one window, and a broadcast with that bound.
    first = parts.groupBy("part").agg(F.min(F.struct("id", "h")).alias("least"))
    line = Window.partitionBy(F.lit(1)).orderBy("part")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(line), F.max("part").over(whole))
    first = stage(first.select(F.col("part").alias("of"), "least", before.alias("before")), "first-rows")
    leads = (F.col("id").eqNullSafe(F.col("least.id"))) & (F.col("h") == F.col("least.h"))
    places = F.when(leads, F.array(F.struct("part", F.lit(True).alias("own")),
                                   F.struct(F.col("before").alias("part"), F.lit(False).alias("own")))
                    ).otherwise(F.array(F.struct("part", F.lit(True).alias("own"))))
    sent = (parts.join(F.broadcast(first), F.col("part") == F.col("of"), "left")
            .select("id", "text", "h", "times", F.explode(places).alias("p"))
            .select("id", "text", "h", "times", "p.part", "p.own")
            .repartition("part").withColumn("fingerprint", fingerprint("text")))
    order = Window.partitionBy("part").orderBy(F.col("own").desc(), F.col("id").asc_nulls_first(), "h", "text")
    paired = sent.select("*", F.lead("text").over(order).alias("next_text"),
                         F.lead("fingerprint").over(order).alias("next_fingerprint"))
    return paired.where("own").select("id", "text", "fingerprint", "next_text", "next_fingerprint", "times")


def op12_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of ``documents`` and of their edited texts (contract of the query).

    Rows that share id and text: all but one of them have that same text as the next.
    """
    pairs = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    # The copies of a row are followed by the row itself.
    each = F.expr("if(times = 1, array(struct(next_text as t, next_fingerprint as f, 1L as n)), array("
                  "struct(next_text as t, next_fingerprint as f, 1L as n), "
                  "struct(text as t, fingerprint as f, times - 1 as n)))")
    rows = (pairs.withColumn("_e", F.explode(each))
            .select("id", "text", "fingerprint", F.col("_e.t").alias("next_text"), F.col("_e.f").alias("next_fingerprint"),
                    F.col("_e.n").alias("n"), F.length("text").cast("long").alias("n_chars")))
    edited = rows.withColumn("edited", F.expr(
        "concat(substring(text, 1, cast(n_chars - n_chars div 2 as int)), substring(next_text, 1, cast(n_chars div 2 as int)))"))
    marked = edited.select("id", "n_chars", "fingerprint", "next_fingerprint", "n",
                           F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                           fingerprint("edited").alias("edited_fingerprint"))
    near = marked.withColumns({"near_edited": likeness("fingerprint", "edited_fingerprint"),
                               "near_next": likeness("fingerprint", "next_fingerprint")})
    return near.withColumn("_copy", F.expr("explode(sequence(1L, n))")).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next")
