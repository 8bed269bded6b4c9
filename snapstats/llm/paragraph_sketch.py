"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in native expressions only.

A paragraph's digest falls into three cells, one of each third of the sketch; a cell holds how many digests it
has, their xor, and the xor of their checks. Cells of two versions subtract; peeling takes digests out of cells
that hold just one until nothing is left, and so recovers the digests by which the versions differ. If something
is left, the digests are split into as many sketches as their number asks for, one to a row, and those that
still fail are tried larger; a difference that no sketch gives back is taken from the digests themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import cut

#: Characters after which a paragraph ends at the next sentence end, if the line does not end before.
PARAGRAPH = 160
#: Cells in each third of a sketch: of the fingerprint, and of larger sketches that are tried when it fails.
THIRD = 8
LARGER = (16, 32)
#: Digests that a sketch of the split ones gets on average, at most.
LOAD = 8
#: Rows between two bounds of the id order, and bounds at most (they are numbers kept by the driver).
ORDER_ROWS, ORDER_BOUNDS = 2000, 65535

DIGESTS = rf"""array_distinct(transform(
    regexp_extract_all({{text}}, '[^\\n]{{{{{PARAGRAPH}}}}}[^\\n.!?]*[.!?]+|[^\\n]+', 0),
    x -> cast(conv(substr(md5(cast(x as binary)), 1, 15), 16, 10) as bigint)))"""


def check(key: str) -> str:
    """A second digest of a digest."""
    return f"(({key} % 1000003) * 999983 + ({key} div 1000003)) % 2147483647"


def places(key: str, third: int) -> list[str]:
    """The digest's cell in each third of the sketch."""
    return [f"cast(shiftright({key}, {10 * n}) & {third - 1} as int) + {n * third}" for n in range(3)]


def sketch(keys: str, third: int = THIRD) -> str:
    """The cells of an array of digests; places and checks are computed once for each."""
    a, b, c = places("x", third)
    known = f"transform({keys}, x -> named_struct('key', x, 'check', {check('x')}, 'a', {a}, 'b', {b}, 'c', {c}))"
    thirds = [f"""transform(sequence({n * third}, {(n + 1) * third - 1}), place -> aggregate(
        filter(known, x -> x.{name} = place), named_struct('n', 0L, 'key', 0L, 'check', 0L),
        (s, x) -> named_struct('n', s.n + 1L, 'key', s.key ^ x.key, 'check', s.check ^ x.check)))""" for n, name in enumerate("abc")]
    return f"transform(array({known}), known -> concat({', '.join(thirds)}))[0]"


def minus(one: str, two: str) -> str:
    return f"zip_with({one}, {two}, (p, q) -> named_struct('n', p.n - q.n, 'key', p.key ^ q.key, 'check', p.check ^ q.check))"


def peeled(cells: str, third: int = THIRD) -> str:
    """Digests recovered from a difference, an array; null if some are left."""
    a, b, c = places("c.key", third)
    step = f"""coalesce(get(transform(transform(slice(filter(s.cells,
            (c, place) -> abs(c.n) = 1 and c.check = {check('c.key')} and place in ({a}, {b}, {c})), 1, 1),
        c -> named_struct('n', c.n, 'key', c.key, 'check', c.check, 'a', {a}, 'b', {b}, 'c', {c})),
        p -> named_struct(
            'cells', transform(s.cells, (c, place) -> if(place = p.a or place = p.b or place = p.c,
                named_struct('n', c.n - p.n, 'key', c.key ^ p.key, 'check', c.check ^ p.check), c)),
            'found', concat(s.found, array(p.key)))), 0), s)"""
    return f"""aggregate(sequence(1, {3 * third}), named_struct('cells', {cells}, 'found', cast(array() as array<bigint>)),
        (s, i) -> {step},
        s -> if(forall(s.cells, c -> c.n = 0L and c.key = 0L and c.check = 0L), s.found, null))"""


def difference(one: str, two: str) -> str:
    """Digests in one array only, by sketches of growing size; by the digests themselves in the end."""
    tries = [peeled(minus(sketch(one, m), sketch(two, m)), m) for m in (THIRD, *LARGER)]
    return f"coalesce({', '.join(tries)}, concat(array_except({one}, {two}), array_except({two}, {one})))"


def printed(cells: str) -> str:
    return f"array_join(transform({cells}, c -> if(c.n = 0L, '-', concat(c.n, ':', lower(hex(c.key)), ':', lower(hex(c.check))))), ' ')"


def followers(docs: DataFrame, *, key: str, text: str) -> DataFrame:
    """doc_id, text and following: the text of the next row by descending key, the first row's after the last.

    Rows are dealt by bounds of the key; the highest row of each range is also dealt to the range above it (the
    highest of all to the lowest range). Null keys come last; rows of one key are in the order of their texts.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    many = min(ORDER_BOUNDS, 1 + rows.count() // ORDER_ROWS)
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", [k / many for k in range(1, many)] or [0.5], 20 * many)).first()[0] or []))
    if bounds:
        halving = [1 << k for k in reversed(range(len(bounds).bit_length()))]
        place = F.expr(f"""aggregate(array({', '.join(map(str, halving))}), 0, (at, step) ->
            if(at + step <= {len(bounds)} and element_at(array({', '.join(f'{b}L' for b in bounds)}), at + step) < coalesce(doc_id, {bounds[0]}L), at + step, at))""")
    else:
        place = F.lit(0)
    rows = rows.withColumn("part", place)
    tops = sorted((r["part"], r["top"]) for r in rows.groupBy("part").agg(F.max("doc_id").alias("top")).collect())
    if not tops:
        return rows.select("doc_id", "text", F.col("text").alias("following"))
    guests = docs.sparkSession.createDataFrame(
        [(part, top, tops[(n + 1) % len(tops)][0]) for n, (part, top) in enumerate(tops)], "part int, top bigint, above int")
    dealt = rows.join(F.broadcast(guests), "part").select(  # at most ORDER_BOUNDS + 1 rows of three numbers
        "doc_id", "text", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("top")), F.array(
            F.struct(F.col("part"), F.lit(False).alias("guest")), F.struct(F.col("above").alias("part"), F.lit(True).alias("guest"))))
            .otherwise(F.array(F.struct(F.col("part"), F.lit(False).alias("guest"))))).alias("x")).select("doc_id", "text", "x.*")
    return dealt.selectExpr("doc_id", "text", "guest", """lead(text) over (
        partition by part order by guest, doc_id desc nulls last, text desc) as following""").where("not guest").drop("guest")


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces the last half of the characters by the first of the next document, by descending
    doc_id. A likeness is common over all distinct paragraph digests, by the recovered difference; 1 for two
    texts without paragraphs. A null text is empty. Repeated rows follow each other, and equal texts have equal
    fingerprints whatever the row. The only row of a table follows itself.
    """
    rows = followers(docs, key=key, text=text).select(
        "doc_id", "text", "following", F.length("text").cast("bigint").alias("n_chars")).withColumn(
        "edited", F.expr("concat(left(text, cast(n_chars - n_chars div 2 as int)), left(following, cast(n_chars div 2 as int)))"))
    read = cut(rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                           *(F.expr(DIGESTS.format(text=c)).alias(k) for c, k in (("text", "own"), ("edited", "new"), ("following", "next")))))
    small = read.withColumn("row", F.monotonically_increasing_id()) \
        .withColumns({f"{k}_cells": F.expr(sketch(k)) for k in ("own", "new", "next")}) \
        .selectExpr("*", f"size({peeled(minus('own_cells', 'new_cells'))}) as d_new", f"size({peeled(minus('own_cells', 'next_cells'))}) as d_next") \
        .drop("own_cells", "new_cells", "next_cells")
    small = cut(small.withColumns({c: F.expr(f"if({c} < 0, null, {c})") for c in ("d_new", "d_next")}))
    # What the fingerprint's own size can't give back: a row for each of as many sketches as there are digests for.
    left = small.where("d_new is null or d_next is null").select("row", "own", "new", "next", F.expr(
        f"cast(power(2, ceil(log2(greatest(size(own), size(new), size(next)) / {LOAD}))) as bigint)").alias("parts"))
    split = left.select("row", "parts", F.explode(F.expr("""concat(
        transform(own, x -> named_struct('side', 0, 'x', x)), transform(new, x -> named_struct('side', 1, 'x', x)),
        transform(next, x -> named_struct('side', 2, 'x', x)))""")).alias("k")) \
        .groupBy("row", F.expr("shiftright(k.x, 30) & (parts - 1)").alias("part")) \
        .agg(*(F.collect_list(F.when(F.col("k.side") == n, F.col("k.x"))).alias(c) for n, c in enumerate(("own", "new", "next"))))
    larger = split.select("row", F.expr(f"size({difference('own', 'new')})").alias("l_new"),
                          F.expr(f"size({difference('own', 'next')})").alias("l_next")) \
        .groupBy("row").agg(F.sum("l_new").alias("l_new"), F.sum("l_next").alias("l_next"))
    near = "if(size(own) + size({k}) = 0, 1D, (size(own) + size({k}) - coalesce(l_{k}, d_{k})) / (size(own) + size({k}) + coalesce(l_{k}, d_{k})))"
    return small.join(larger, "row", "left").select(
        "doc_id", "n_chars", "edited_sha256",  # printed cells are longer than digests: only the latter are moved
        F.expr(printed(sketch("own"))).alias("fingerprint"), F.expr(printed(sketch("new"))).alias("edited_fingerprint"),
        F.expr(near.format(k="new")).alias("near_edited"), F.expr(near.format(k="next")).alias("near_next"))
