"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame functions only.

A text's paragraphs, long ones cut every 16 words, are hashed to 64 bits. Each digest goes into one
cell of each of three rows of a sketch; a cell keeps how many it got, their exclusive or and
that of their check sums. The sketches of two versions subtract cell by cell, which leaves
what differs. A cell with a single digest left gives it away; taking it out of its other cells
frees more of them, until nothing is left or the sketch was too small. Then the digests
are dealt over two, four or eight sketches by their number, a larger one in all, and what fails again over more.

All of it happens within a row: texts are shuffled once, to find the next document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import staged, whole_text

#: A paragraph's piece: up to 16 words of a line, of up to 64 characters each.
PIECE = r"[^\s]{1,64}+(?:[ \t]++[^\s]{1,64}+){0,15}+"
#: Cells of a row of a sketch, rows, steps of peeling, sketches a failing one is dealt over, and how often.
WIDTH, ROWS, STEPS, FAN, DEPTH = 16, 3, 12, 8, 6
#: Digests of both sides together that each dealt sketch of two or four is to get at most.
LOAD = 24
#: Documents of one stretch of ids, within which each one's next is looked up.
STRETCH = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def digests(text: Column) -> Column:
    """The different digests of a text's pieces."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECE), 0), lambda piece: F.xxhash64(piece)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check")).bitwiseAND(0xFFFFFFFF)


def _cells(key: Column, level: Column) -> Column:
    """The cell of each row that a digest belongs to."""
    mixed = F.xxhash64(key, level)
    return let(mixed, lambda h: F.array(*[F.pmod(F.shiftright(h, 20 * r), F.lit(WIDTH)).cast("int") + r * WIDTH for r in range(ROWS)]))


def sketch(keys: Column, level: Column) -> Column:
    """The cells of an array of digests: n, key, check."""
    keyed = F.transform(keys, lambda k: F.struct(k.alias("key"), _check(k).alias("check"), _cells(k, level).alias("at")))

    def cell(members: Column) -> Column:
        xor = lambda part: F.aggregate(members, F.lit(0).cast("long"), lambda a, m: a.bitwiseXOR(m[part]))
        return F.struct(F.size(members).alias("n"), xor("key").alias("key"), xor("check").alias("check"))

    def row(all_: Column, r: int) -> Column:
        own = lambda i: F.filter(all_, lambda m: m["at"][r] == i)
        return F.transform(F.sequence(F.lit(r * WIDTH), F.lit((r + 1) * WIDTH - 1)), lambda i: let(own(i), cell))

    return let(keyed, lambda all_: F.concat(*[row(all_, r) for r in range(ROWS)]))


def subtract(a: Column, b: Column) -> Column:
    """What two sketches differ by; what both have is gone."""
    return F.zip_with(
        a,
        b,
        lambda x, y: F.struct(
            (x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")
        ),
    )


def peel(cells: Column, level: Column) -> Column:
    """Of a difference: how many digests only the first and only the second had, and whether all were recovered."""
    pure = lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"]))
    found = lambda state: F.array_distinct(
        F.transform(
            F.filter(state["cells"], pure),
            lambda c: F.struct(c["key"].alias("key"), c["n"].alias("n"), c["check"].alias("check"), _cells(c["key"], level).alias("at")),
        )
    )

    def without(cell: Column, number: Column, gone: Column) -> Column:
        own = F.filter(gone, lambda g: g["at"][F.floor(number / WIDTH).cast("int")] == number)
        return F.aggregate(
            own,
            cell,
            lambda c, g: F.struct(
                (c["n"] - g["n"]).alias("n"), c["key"].bitwiseXOR(g["key"]).alias("key"), c["check"].bitwiseXOR(g["check"]).alias("check")
            ),
        )

    def step(state: Column, _: Column) -> Column:
        following = let(
            found(state),
            lambda gone: F.struct(
                F.transform(state["cells"], lambda c, i: without(c, i, gone)).alias("cells"),
                (state["first"] + F.size(F.filter(gone, lambda g: g["n"] > 0))).alias("first"),
                (state["second"] + F.size(F.filter(gone, lambda g: g["n"] < 0))).alias("second"),
                (F.size(gone) > 0).alias("going"),
            ),
        )
        return F.when(state["going"], following).otherwise(state)

    start = F.struct(cells.alias("cells"), F.lit(0).alias("first"), F.lit(0).alias("second"), F.lit(True).alias("going"))
    empty = lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        start,
        step,
        lambda s: F.struct(s["first"].alias("first"), s["second"].alias("second"), F.forall(s["cells"], empty).alias("whole")),
    )


def _dealt(a: Column, b: Column, level: Column) -> Column:
    """Two arrays of digests as up to FAN pairs of arrays, by the next bits of the digests; fewer where few digests can differ."""
    n = F.size(a) + F.size(b)
    fan = F.when(n <= 2 * LOAD, 2).when(n <= 4 * LOAD, 4).otherwise(FAN)
    bits = lambda k: F.call_function("shiftrightunsigned", F.xxhash64(k, F.lit("part")), level * 3)

    def parts(fan: Column) -> Column:
        part = lambda keys, g: F.filter(keys, lambda k: F.pmod(bits(k), fan) == g)
        return F.transform(F.sequence(F.lit(0), fan - 1), lambda g: F.struct(part(a, g).alias("a"), part(b, g).alias("b")))

    return let(fan, parts)


def difference(a_cells: Column, b_cells: Column, a: Column, b: Column) -> Column:
    """first and second: how many digests only `a` and only `b` have, from their sketches, or larger ones where those fail.

    After DEPTH times larger ones, up to eight times as large each, what still fails is compared digest by digest.
    """

    def step(state: Column, level: Column) -> Column:
        tried = F.transform(
            state["parts"],
            lambda p: F.struct(peel(subtract(sketch(p["a"], level), sketch(p["b"], level)), level).alias("got"), p.alias("of")),
        )

        def following(tried: Column) -> Column:
            count = lambda side: F.aggregate(tried, state[side], lambda n, t: F.when(t["got"]["whole"], n + t["got"][side]).otherwise(n))
            failed = F.filter(tried, lambda t: ~t["got"]["whole"])
            parts = F.flatten(F.transform(failed, lambda t: _dealt(t["of"]["a"], t["of"]["b"], level)))
            return F.struct(parts.alias("parts"), count("first").alias("first"), count("second").alias("second"))

        return F.when(F.size(state["parts"]) == 0, state).otherwise(let(tried, following))

    def larger() -> Column:
        start = F.struct(_dealt(a, b, F.lit(0)).alias("parts"), F.lit(0).alias("first"), F.lit(0).alias("second"))
        rest = lambda s, one, other: F.aggregate(s["parts"], F.lit(0), lambda n, p: n + F.size(F.array_except(p[one], p[other])))
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(DEPTH)),
            start,
            step,
            lambda s: F.struct((s["first"] + rest(s, "a", "b")).alias("first"), (s["second"] + rest(s, "b", "a")).alias("second")),
        )

    return let(
        peel(subtract(a_cells, b_cells), F.lit(0)),
        lambda got: F.when(got["whole"], F.struct(got["first"].alias("first"), got["second"].alias("second"))).otherwise(larger()),
    )


def likeness(a: Column, b: Column, only_a: Column) -> Column:
    """Twice what two sets share by their sizes together; 1 for two empty ones."""
    together = F.size(a) + F.size(b)
    return F.when(together == 0, 1.0).otherwise((F.size(a) - only_a) * 2 / together)


def written(cells: Column) -> Column:
    """A sketch as a string: 16 bytes a cell, in base 64."""
    digits = lambda c: F.concat(F.lpad(F.hex(c["n"]), 8, "0"), F.lpad(F.hex(c["key"]), 16, "0"), F.lpad(F.hex(c["check"]), 8, "0"))
    return F.base64(F.unhex(F.array_join(F.transform(cells, digits), "")))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text: that of the next document in order of doc_id (NULLs last) and text; after the last comes the first.

    `docs` has doc_id and text; other columns are ignored, a NULL text counts as empty. Ids are cut
    into stretches of about STRETCH rows at their mean density, and the first document of a
    stretch also goes, as a guest, to the one before; so no order over all rows is needed.
    The table of stretches, two numbers each, is ordered in one task.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).head()
    low, high = (low, high) if low is not None else (0, 0)
    width = min(2**62, max(1, (high - low + 1) * STRETCH // max(1, n)))
    stretch = F.floor((F.col("doc_id").cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("long")
    rows = rows.withColumn("stretch", F.coalesce(stretch, F.lit((high - low) // width + 1)))
    firsts = rows.groupBy("stretch").agg(F.min("doc_id").alias("first_id"))
    in_order = Window.orderBy("stretch")
    last = F.max("stretch").over(Window.partitionBy())
    before = F.coalesce(F.lag("stretch").over(in_order), last)
    firsts, _ = staged(firsts.select("first_id", F.col("stretch").alias("own"), before.alias("before")), "sketch-stretches")
    joined = rows.join(firsts, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("stretch") == F.col("own")), "left")
    place = lambda at, guest: F.struct(F.col(at).alias("stretch"), F.lit(guest).alias("guest"))
    places = F.when(F.col("before").isNull(), F.array(place("stretch", False))).otherwise(
        F.array(place("stretch", False), place("before", True))
    )
    placed = joined.select("doc_id", "text", F.explode(places).alias("place")).select("doc_id", "text", "place.stretch", "place.guest")
    order = Window.partitionBy("stretch").orderBy("guest", F.asc_nulls_last("doc_id"), "text")
    return placed.withColumn("next_text", F.lead("text").over(order)).where(~F.col("guest")).select("doc_id", "text", "next_text")


def compare_versions(docs: DataFrame) -> DataFrame:
    """Every text against an edited version of it and against the next document.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next. The edited text
    ends with the first quarter as many code points of the next document in place of its own last quarter. A
    likeness is twice the shared digests by all of both. A NULL text counts as empty, and has no
    digests; a paragraph that repeats counts once. Repeated rows are documents of their own; a
    single document is its own next. No rows give no rows.
    """
    n, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = with_next(docs).select("doc_id", "text", "next_text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    hashed = F.struct(digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("edited"), digests(F.col("next_text")).alias("next"))

    def compared(keys: Column, cells: Column) -> Column:
        near = lambda other: let(
            difference(cells["own"], cells[other], keys["own"], keys[other]), lambda d: likeness(keys["own"], keys[other], d["first"])
        )
        return F.struct(
            written(cells["own"]).alias("fingerprint"),
            written(cells["edited"]).alias("edited_fingerprint"),
            near("edited").alias("near_edited"),
            near("next").alias("near_next"),
        )

    sketches = lambda keys: F.struct(*[sketch(keys[name], F.lit(0)).alias(name) for name in ("own", "edited", "next")])
    result = let(hashed, lambda keys: let(sketches(keys), lambda cells: compared(keys, cells)))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), result.alias("found")).select(
        "doc_id", "n_chars", "edited_sha256", "found.*"
    )
