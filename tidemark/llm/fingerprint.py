"""Order MinHash fingerprints of documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: k-mers are so many code points in a row. All of them count: those whose hash is a multiple of EVERY, which is one.
SIZE, EVERY = 4, 1
#: Bins are the first BITS bits of a hash; each keeps its two smallest k-mers; BIN_HASH bits of their tuple's hash stay.
BITS, BIN_HASH = 6, 16
#: So many k-mers of a bin are kept, as far as chance has it, before its two smallest are sought.
MANY = 12
#: Runs of one k-mer are numbered in rows if texts have fewer k-mers than two to so many; ``signature`` is asked for longer ones.
LONGEST = 21
#: About so many code points are dealt to a task.
PART = 4_000_000
#: Sorted longs hold a hash in their upper half and a place in their lower one.
HALF = 32


#: The halves of a long.
UPPER, LOWER = -(1 << HALF), (1 << HALF) - 1


def _windows(text: Column) -> Column:
    """Every SIZE code points in a row, in order."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * SIZE}))."), F.lit(1))


def _hashed(kmers: Column) -> Column:
    return F.transform(kmers, lambda x: F.xxhash64(x))


def _kmers(text: Column) -> Column:
    """Every k-mer's hash, in text order; a text shorter than a k-mer is one.

    An edit takes away and adds only k-mers that it touches, in texts without spaces too.
    """
    return _hashed(F.when(F.char_length(text) < SIZE, F.filter(F.array(text), lambda t: t != "")).otherwise(_windows(text)))


def _edited_kmers(kmers: Column, edited: Column, kept: Column) -> Column:
    """The same of a text whose first ``kept`` code points are those of the text of ``kmers``."""
    shared = kept - (SIZE - 1)
    after = _windows(edited.substr(shared + 1, F.char_length(edited)))
    return F.when(shared > 0, F.concat(F.slice(kmers, 1, shared), _hashed(after))).otherwise(_kmers(edited))


def _placed(kmers: Column) -> Column:
    """Each k-mer's hash above its place, sorted."""
    return F.sort_array(F.transform(kmers, lambda h, i: h.bitwiseAND(F.lit(UPPER)).bitwiseOR(i.cast("long"))))


def _numbered(s: Column) -> Column:
    """Of each sorted k-mer the hash with its number among its repeats, above its index in ``s``; not sorted."""
    def starts(x: Column) -> Column:
        inner = lambda before: F.filter(F.sequence(F.lit(1), F.size(x) - 1), lambda j: F.get(before, j) < F.get(x, j).bitwiseAND(F.lit(UPPER)))
        return F.when(F.size(x) > 1, _let(F.concat(F.array(F.lit(None).cast("long")), x), inner)).otherwise(F.array().cast("array<int>")).cast("array<long>")

    def run(x: Column, lo: Column, hi: Column) -> Column:
        # What doesn't change within a run is computed once for it.
        number = lambda h: F.transform(F.sequence(lo, hi - 1), lambda j, n: F.xxhash64(h, n).bitwiseAND(F.lit(UPPER)).bitwiseOR(j))
        return _let(F.shiftright(F.get(x, lo.cast("int")), HALF), number)

    def runs(x: Column) -> Column:
        zero, end = F.array(F.lit(0).cast("long")), F.array(F.size(x).cast("long"))
        return F.when(F.size(x) > 0, _let(starts(x), lambda at: F.zip_with(F.concat(zero, at), F.concat(at, end), lambda lo, hi: run(x, lo, hi))))

    # A cast empty array could hold nulls by its type, and only arrays that can't are sorted as plain longs.
    return F.coalesce(F.flatten(_let(s, runs)), F.slice(s, 1, 0))


def _bins(kmers: Column, s: Column, w: Column) -> Column:
    """An int for each bin that has k-mers, from those in text order, ``_placed`` and the sorted ``_numbered``."""
    def of(e: Column) -> Column:
        return F.shiftright(e, 64 - BITS)

    def low(e: Column) -> Column:
        return e.bitwiseAND(F.lit(LOWER)).cast("int")

    def tuple_hash(kmers: Column, two: Column) -> Column:
        known = lambda e: (F.get(kmers, low(e)), F.shiftright(e, HALF))
        a, b = F.get(two, 0), F.get(two, 1)
        return F.when(b.isNull(), F.xxhash64(*known(a))).when(low(a) < low(b), F.xxhash64(*known(a), *known(b))).otherwise(F.xxhash64(*known(b), *known(a)))

    def one(kmers: Column, s: Column, w: Column, powers: Column, b: Column) -> Column:
        # A bin's first index is searched for in the sorted array.
        step = lambda m: F.aggregate(powers, F.lit(0), lambda at, p: F.when(F.get(w, at + p - 1) < m, at + p).otherwise(at))
        first = _let(F.shiftleft(b.cast("long"), 64 - BITS), step)
        # Equal hashes are told apart by place, which a third beside the two smallest settles.
        three = lambda i: F.filter(F.array(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), lambda e: of(e) == b)
        place = lambda e: e.bitwiseAND(F.lit(UPPER)).bitwiseOR(F.get(s, low(e)).bitwiseAND(F.lit(LOWER)))
        found = _let(first, lambda i: F.sort_array(F.transform(three(i), place)))
        # What is known to be non-negative keeps the ints in order of their bins.
        return _let(found, lambda two: F.when(F.size(two) > 0, (b + (1 << (BITS - 1))) * (1 << BIN_HASH) + F.pmod(tuple_hash(kmers, two), F.lit(1 << BIN_HASH)).cast("int")))

    half = 1 << (BITS - 1)
    powers = F.transform(F.sequence(F.length(F.bin(F.size(w))) - 1, F.lit(0)), lambda i: F.call_function("shiftleft", F.lit(1), i))
    each = lambda k, s, w, p: F.transform(F.sequence(F.lit(-half), F.lit(half - 1)), lambda b: one(k, s, w, p, b))
    return F.filter(_let(kmers, lambda k: _let(s, lambda s: _let(w, lambda w: _let(powers, lambda p: each(k, s, w, p))))), lambda x: x.isNotNull())


def signature(text: Column) -> Column:
    """Order MinHash of a text: an array of ints, bin above tuple hash, one for each bin that has k-mers.

    Every SIZE code points in a row are a k-mer (a shorter text is one itself), numbered among its repeats by the upper
    half of its hash. The number's hash gives its bin; of each bin the two smallest are put back in text order, and that
    tuple is hashed. So a bin changes when one of its k-mers goes, comes or changes places, and one changed character
    touches SIZE k-mers. Arrays of longs, hash above place, are sorted instead of structs.
    """
    return _let(_kmers(text), lambda k: _let(_placed(k), lambda s: _let(F.sort_array(_numbered(s)), lambda w: _bins(k, s, w))))


def _chosen(df: DataFrame, keep: list[str], k: str, s: str, l: str, t: str, info: Column, group: list[str]) -> DataFrame:
    """Of each row, the numbered k-mers of both texts that may be among a bin's two smallest: (group, info, a, b), a and b of structs (hash above place, k-mer).

    Every k-mer is a row for a moment, since that is compiled; those above ``_bound`` are left before anything is kept of them.
    """
    n, x = F.size(s), F.concat(s, t)
    df = df.select("*", n.alias("sig_n"), F.size(t).alias("sig_m"), x.alias("sig_x"))
    # One row more carries what isn't of k-mers; others are the first ones of their runs.
    df = df.select("*", F.explode(F.sequence(F.lit(0), F.size("sig_x"))).alias("sig_lo"))
    df = df.select("*", F.spark_partition_id().alias("sig_first"), F.get("sig_x", "sig_lo").bitwiseAND(F.lit(UPPER)).alias("sig_h"))
    starts = (F.col("sig_lo") == 0) | (F.col("sig_lo") == F.col("sig_n")) | (F.get("sig_x", F.col("sig_lo") - 1) < F.col("sig_h")) | F.col("sig_h").isNull()
    df = df.where((F.col("sig_first") >= 0) & starts).drop("sig_first")
    df = df.select("*", (F.col("sig_lo") < F.col("sig_n")).alias("sig_own"), F.col("sig_lo").alias("sig_at"))
    either = lambda x, y: F.when(F.col("sig_own"), x).otherwise(y)
    # A run's last index is found by going on by falling powers of two while the hash is the same.
    for p in range(LONGEST - 1, -1, -1):
        on = F.col("sig_at") + (1 << p)
        same = (F.get("sig_x", on) <= F.col("sig_h").bitwiseOR(F.lit(LOWER))) & ((on < F.col("sig_n")) == F.col("sig_own"))
        df = df.select(*[c for c in df.columns if c != "sig_at"], F.when(same, on).otherwise(F.col("sig_at")).alias("sig_at"))
    df = df.select("*", F.explode(F.sequence("sig_lo", "sig_at")).alias("sig_i"))
    df = df.select("*", F.get("sig_x", "sig_i").alias("sig_e"))
    # What a task alone knows keeps Spark from moving the condition below, which would write out all powers within one another.
    df = df.select("*", F.xxhash64(F.shiftright("sig_h", HALF), F.col("sig_i") - F.col("sig_lo")).alias("sig_g"), F.spark_partition_id().alias("sig_task"))
    last = F.col("sig_i") == F.size("sig_x")
    low = F.shiftright("sig_g", HALF).bitwiseAND(F.lit((1 << (HALF - BITS)) - 1))
    df = df.where((F.col("sig_task") >= 0) & (last | (low < either(_bound(F.col("sig_n")), _bound(F.col("sig_m"))))))
    place = F.col("sig_e").bitwiseAND(F.lit(LOWER))
    v = F.col("sig_g").bitwiseAND(F.lit(UPPER)).bitwiseOR(place)
    kmer = either(F.get(k, place.cast("int")), F.get(l, place.cast("int")))
    df = df.select(*group, F.when(last, info).alias("sig_info"), "sig_own", last.alias("sig_last"), v.alias("v"), kmer.alias("h"))
    of = lambda c: F.collect_list(F.when(c & ~F.col("sig_last"), F.struct("v", "h")))
    return df.groupBy(*group).agg(F.first("sig_info", ignorenulls=True).alias("sig_info"), of(F.col("sig_own")).alias("sig_a"), of(~F.col("sig_own")).alias("sig_b"))


def _bound(n: Column) -> Column:
    """What the lower bits of a hash stay below, so that some MANY of a bin are expected to; of fewer k-mers than MANY a bin, all."""
    return F.when(n <= MANY << BITS, F.lit(1 << (HALF - BITS)).cast("long")).otherwise(F.floor(F.lit(float(MANY << HALF)) / n))


def _chosen_bins(chosen: Column, n: Column) -> Column:
    """``_bins`` from sorted structs of ``_chosen``; null if ``n`` k-mers were more and a bin hasn't two of them here."""
    def one(x: Column, powers: Column, b: Column) -> Column:
        step = lambda least: F.aggregate(powers, F.lit(0), lambda at, p: F.when(F.get(x, at + p - 1)["v"] < least, at + p).otherwise(at))
        known = lambda e: (e["h"], F.shiftright(e["v"], HALF))
        mine = lambda e: F.shiftright(e["v"], 64 - BITS) == b
        place = lambda e: e["v"].bitwiseAND(F.lit(LOWER))
        tuple_hash = lambda c, d: F.when(~F.coalesce(mine(d), F.lit(False)), F.when(F.size(x) == n, F.xxhash64(*known(c)))).when(place(c) < place(d), F.xxhash64(*known(c), *known(d))).otherwise(F.xxhash64(*known(d), *known(c)))
        found = lambda i: F.when(mine(F.get(x, i)), F.coalesce((b + (1 << (BITS - 1))) * (1 << BIN_HASH) + F.pmod(tuple_hash(F.get(x, i), F.get(x, i + 1)), F.lit(1 << BIN_HASH)).cast("int"), F.lit(-1)))
        return _let(_let(F.shiftleft(b.cast("long"), 64 - BITS), step), found)

    half = 1 << (BITS - 1)
    powers = lambda x: F.transform(F.sequence(F.length(F.bin(F.size(x))) - 1, F.lit(0)), lambda i: F.call_function("shiftleft", F.lit(1), i))
    each = lambda x, p: F.filter(F.transform(F.sequence(F.lit(-half), F.lit(half - 1)), lambda b: one(x, p, b)), lambda y: y.isNotNull())
    whole = lambda x, y: F.when((n < 1 << LONGEST) & ((F.size(x) == n) | ((F.size(y) == 2 * half) & ~F.array_contains(y, F.lit(-1)))), y)
    return _let(chosen, lambda x: _let(_let(powers(x), lambda p: each(x, p)), lambda y: whole(x, y)))


def signatures(rows: DataFrame, text: str, edited: str, kept: Column, sig: str, edited_sig: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with the ``signature`` of a text and of an edited one, whose first ``kept`` code points are the text's, in their place.

    Names that begin with ``sig_`` are taken. The k-mers that both texts begin with are hashed once. Repeats are numbered and hashed in compiled rows, of
    which a bound on the hash leaves few; where it left a bin fewer than two, ``signature`` is asked. Rows that are dealt out by the columns ``by`` stay where they are.
    """
    keep = [c for c in rows.columns if c not in (text, edited)]

    def step(df: DataFrame, **columns: Column) -> DataFrame:
        # An inline of one row keeps Spark from merging projections, which would compute what they share again and again.
        df = df.select("*", *[c.alias(f"{n} now") for n, c in columns.items()])
        now = F.inline(F.array(F.struct(*[F.col(f"`{n} now`").alias(n) for n in columns])))
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns and not c.endswith(" now")], now)

    df = step(rows.withColumn("sig_row", F.monotonically_increasing_id()), sig_k=_kmers(F.col(text)), sig_kept=kept)
    df = step(df, sig_k=F.col("sig_k"), sig_l=_edited_kmers(F.col("sig_k"), F.col(edited), F.col("sig_kept")))
    df = step(df, sig_s=_placed(F.col("sig_k")), sig_t=_placed(F.col("sig_l")))
    info = F.struct(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).alias("text"), F.col(edited).alias("edited"), F.col("sig_n").alias("n"), F.col("sig_m").alias("m"))
    df = _chosen(df, keep, "sig_k", "sig_s", "sig_l", "sig_t", info, [*by, "sig_row"])
    df = step(df, sig_a=F.sort_array("sig_a"), sig_b=F.sort_array("sig_b"))
    made = lambda chosen, n, text: F.coalesce(_chosen_bins(F.col(chosen), F.col("sig_info")[n]), signature(F.col("sig_info")[text]))
    return df.select("sig_info.row.*", made("sig_a", "n", "text").alias(sig), made("sig_b", "m", "edited").alias(edited_sig))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row."""
    # What finishes an aggregation isn't copied, as a transformed element would be.
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def printed(sig: Column) -> Column:
    """A signature as text: six hexadecimal digits for each bin."""
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of bins, of those that either has, which are equal; two empty signatures are equal."""
    def bins(s: Column) -> Column:
        return F.transform(s, lambda x: F.shiftright(x, BIN_HASH))

    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, its edited text's, and their likenesses.

    The edited text: the last floor(n/2) code points replaced by the first as many, or all, of the next document in
    descending id, after the last the first. Returns ``(doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next)``.

    Null text: empty. Rows that share an id have the same next document, and the one of them that stands for them
    as a next document is the first by a hash of its text. White space counts like any other character. Null ids count as one id, the least (-2^63 is kept for
    it). One id alone is its own next. Empty input: empty output.
    """
    none = -(1 << 63)
    scratch = Scratch(docs.sparkSession, "fingerprint")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(none)).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = scratch.save(
        rows.groupBy("k").agg(F.max(F.char_length("text")).alias("n"), F.count(F.lit(1)).alias("rows"))
        .repartitionByRange("k").withColumn("part", F.spark_partition_id())
    )
    # Next in descending order: the id before in ascending order. Parts are ranges of ids.
    inside = Window.partitionBy("part").orderBy("k")
    ends = ids.groupBy("part").agg(F.max("k").alias("last"))
    ends = ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("before"))  # a row for each part
    end = ids.agg(F.max("k").alias("k"), F.max("rows").alias("rows"), F.sum(F.col("n").cast("long") * F.col("rows")).alias("chars")).first()
    order = scratch.save(ids.join(F.broadcast(ends), "part").select(  # at most a row for each part of ids
        F.col("k").alias("d"), F.coalesce(F.lag("k").over(inside), "before", F.lit(end["k"] if end["k"] is not None else none)).alias("next"),
        F.floor(F.col("n") / 2).cast("int").alias("need"),
    ))
    heads = rows.join(order, F.col("k") == F.col("next")).select("d", F.expr("substring(text, 1, need)").alias("head"), F.xxhash64("text").alias("turn"))
    repeated = (end["rows"] or 0) > 1
    if repeated:
        heads = heads.groupBy("d").agg(F.min_by("head", "turn").alias("head"))
    # A task sorts what is chosen of its k-mers, which is to fit its memory.
    parts = (end["chars"] or 0) // PART + 1
    both = rows.repartition(parts, "k").join(heads.select("d", "head").repartition(parts, "d"), F.col("k") == F.col("d"))
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.substring(F.col("head"), F.lit(1), F.floor(n / 2).cast("int")))
    out = both.select("k", "text", n.cast("long").alias("n_chars"), F.xxhash64("text").alias("turn"), F.sha2(edited, 256).alias("edited_sha256"), edited.alias("edited"))
    # Signatures are made once, and only they travel from then on.
    signed = signatures(out, "text", "edited", n - F.floor(n / 2).cast("int"), "sig", "edited_sig", by=("k",))
    signed = scratch.save(signed)
    nexts = signed.groupBy("k").agg(F.min_by("sig", "turn").alias("next_sig")) if repeated else signed.select("k", F.col("sig").alias("next_sig"))
    after = order.select("d", "next").join(nexts, F.col("next") == F.col("k")).select("d", "next_sig")
    return signed.join(after, F.col("k") == F.col("d")).select(
        F.when(F.col("k") != none, F.col("k")).alias("doc_id"), "n_chars", "edited_sha256", printed(F.col("sig")).alias("fingerprint"), printed(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
