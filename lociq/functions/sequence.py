"""Column functions on sequences, alignments strings, headers and names. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def entropy(seq: Column) -> Column:
    """Shannon entropy in bits per base, letter case ignored; 0 for an empty sequence."""

    def bits(s: Column) -> Column:
        n = F.length(s)
        share = F.transform(F.array_distinct(F.split(s, "")), lambda c: (n - F.length(F.replace(s, c, F.lit("")))) / n)
        return F.when(n == 0, F.lit(0.0)).otherwise(F.aggregate(F.filter(share, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p)))

    return F.transform(F.array(F.upper(seq)), bits)[0]  # whatever makes the sequence is evaluated once, not for each letter


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def hamming_positions(a: Column, b: Column) -> Column:
    """Positions (from 0) at which a and b differ, up to the shorter one's end."""

    def where(r: Column) -> Column:
        n = F.least(F.length(r.a), F.length(r.b))
        unlike = F.zip_with(F.split(r.a, ""), F.split(r.b, ""), lambda p, q: p != q)
        places = F.filter(F.transform(unlike, lambda d, i: F.when(d, i)), lambda i: i.isNotNull())
        none = (n <= 0) | (n.isNotNull() & (r.a.isNull() | r.b.isNull()))
        return F.when(none, F.array().cast("array<int>")).otherwise(places)

    return F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), where)[0]  # what makes the sequences is evaluated once, not for each letter


def intervals_overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Whether two half-open intervals overlap."""
    return ~((e1 <= s2) | (e2 <= s1))


def cigar_ops(cigar: Column) -> Column:
    """array<struct<n: int, op: string>>"""
    pattern = F.lit(r"(\d+)([=XIDMSHNP])")
    return F.arrays_zip(F.transform(F.regexp_extract_all(cigar, pattern, 1), lambda x: x.cast("int")).alias("n"), F.regexp_extract_all(cigar, pattern, 2).alias("op"))


def cigar_reference_length(cigar: Column) -> Column:
    return F.aggregate(F.filter(cigar_ops(cigar), lambda o: o["op"].isin("M", "D", "N", "=", "X")), F.lit(0), lambda s, o: s + o["n"])


def cigar_clips(cigar: Column) -> tuple[Column, Column]:
    """(left, right) clipped bases, soft or hard."""
    left, right = F.regexp_extract(cigar, r"^(\d+)[SH]", 1), F.regexp_extract(cigar, r"(\d+)[SH]$", 1)
    return tuple(F.when(c == "", F.lit(0)).otherwise(F.coalesce(F.try_to_number(c, F.lit("999999999")).cast("int"), F.lit(0))) for c in (left, right))


def cigar_blocks(cigar: Column, query_start: Column, target_start: Column, min_indel: int) -> Column:
    """Aligned blocks between indels of at least min_indel: array<struct<qs, qe, ts, te, matches, aligned>>.

    Smaller indels move the coordinates inside a block; S moves the query; blocks without an aligned column are left out.
    """
    block = "struct<qs:bigint,qe:bigint,ts:bigint,te:bigint,matches:bigint,aligned:bigint>"
    zero = F.lit(0).cast("long")
    state = F.struct(query_start.cast("long").alias("q"), target_start.cast("long").alias("t"), query_start.cast("long").alias("qs"), target_start.cast("long").alias("ts"), zero.alias("m"), zero.alias("a"), F.array().cast(f"array<{block}>").alias("done"))

    def closed(s: Column) -> Column:
        here = F.struct(s["qs"].alias("qs"), s["q"].alias("qe"), s["ts"].alias("ts"), s["t"].alias("te"), s["m"].alias("matches"), s["a"].alias("aligned"))
        return F.when(s["a"] > 0, F.concat(s["done"], F.array(here))).otherwise(s["done"])

    def step(s: Column, o: Column) -> Column:
        n, op = o["n"].cast("long"), o["op"]
        aligned, large = op.isin("=", "M", "X"), op.isin("D", "I") & (o["n"] >= min_indel)
        q = s["q"] + F.when(aligned | op.isin("I", "S"), n).otherwise(0)
        t = s["t"] + F.when(aligned | (op == "D"), n).otherwise(0)
        return F.struct(
            q.alias("q"), t.alias("t"), F.when(large, q).otherwise(s["qs"]).alias("qs"), F.when(large, t).otherwise(s["ts"]).alias("ts"),
            F.when(large, 0).otherwise(s["m"] + F.when(op.isin("=", "M"), n).otherwise(0)).alias("m"),
            F.when(large, 0).otherwise(s["a"] + F.when(aligned, n).otherwise(0)).alias("a"),
            F.when(large, closed(s)).otherwise(s["done"]).alias("done"),
        )

    return F.aggregate(cigar_ops(cigar), state, step, closed)


def flank(contig: Column, start: Column, end: Column, size: int) -> tuple[Column, Column]:
    """(upstream, downstream) flanks of [start, end), cut off at the contig's ends."""
    first = F.greatest(start - size, F.lit(0))
    return F.substr(contig, first + 1, start - first), F.substr(contig, end + 1, F.lit(size))


def padded(upstream: Column, seq: Column, downstream: Column, pad: int) -> Column:
    """seq with the last `pad` bases of its upstream and the first of its downstream flank; pad 0 keeps the whole upstream flank."""
    before = F.coalesce(upstream, F.lit("")) if pad == 0 else F.right(F.coalesce(upstream, F.lit("")), F.lit(pad))
    return F.concat(before, seq, F.left(F.coalesce(downstream, F.lit("")), F.lit(pad)))


def reference_header(header: Column) -> tuple[Column, Column, Column]:
    """(name, group, family) of `name_group_family`; the name may hold underscores; null if there are fewer than two."""
    pattern = "^(.*)_([^_]*)_([^_]*)$"
    return tuple(F.when(header.rlike(pattern), F.regexp_extract(header, pattern, k)) for k in (1, 2, 3))


def slugify(x: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "_"), F.lit("_"))


def genus(organism: Column) -> Column:
    """First word, after strain and subspecies notes are taken off."""
    return F.element_at(F.split(F.trim(F.regexp_replace(organism, r"\s+(sp\.|subsp\.|serovar|str\.|strain).*$", "")), r"\s+"), 1)


def is_run_accession(x: Column) -> Column:
    return x.rlike("^[SED]RR")


def sample_of_file(name: Column) -> Column:
    """Sample id of a file name: what stands before the first dot, without `_1`, `_2` or `_subreads`."""
    return F.regexp_replace(F.substring_index(name, ".", 1), "_(1|2|subreads)$", "")


def tag(sample: Column, element: Column) -> Column:
    return F.concat_ws("__", sample, F.left(element, F.lit(8)))


def human_size(n: Column) -> Column:
    out = F.concat(F.format_number(n / 1024.0**4, 1), F.lit(" TB"))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        out = F.when(n < 1024.0 ** (power + 1), F.concat(F.format_number(n / 1024.0**power, 1), F.lit(f" {unit}"))).otherwise(out)
    return out


def without_stops(protein: Column) -> Column:
    return F.regexp_replace(protein, r"\*+$", "")


def is_hypothetical(product: Column) -> Column:
    """Whether a product says nothing: null, empty, or beginning with `hypothetical` in any case."""
    return F.coalesce(F.lower(product), F.lit("")).rlike("^(?:$|hypothetical)")


def orf_label(gene: Column, product: Column, index: Column) -> Column:
    """Gene, else a telling product (shortened beyond 30 characters), else orf_N."""
    short = F.when(F.length(product) <= 30, product).otherwise(F.concat(F.left(product, F.lit(27)), F.lit("...")))
    return F.coalesce(F.nullif(gene, F.lit("")), F.when(~is_hypothetical(product), short), F.concat(F.lit("orf_"), index.cast("string")))


def orf_kind(product: Column, domains: Column) -> Column:
    """What an ORF is drawn as: `DEDD+Tnp20`, `DEDD` or `Tnp20` by its domains, else `cargo` with a telling product, else `other`."""
    has = lambda d: F.coalesce(F.array_contains(domains, d), F.lit(False))
    return F.when(has("DEDD") & has("Tnp20"), "DEDD+Tnp20").when(has("DEDD"), "DEDD").when(has("Tnp20"), "Tnp20").when(~is_hypothetical(product), "cargo").otherwise("other")


def orf_title(gene: Column, product: Column, index: Column, length_nt: Column, domains: Column) -> Column:
    """Label with the protein's length and its domains."""
    kind = orf_kind(product, domains)
    tag = F.when(kind.isin("cargo", "other"), "").otherwise(F.concat(F.lit(" "), kind))
    return F.concat(orf_label(gene, product, index), F.lit(" ("), F.floor(length_nt / 3).cast("string"), F.lit("aa)"), tag)


def base_quality(seq: Column, quality: Column) -> Column:
    return F.coalesce(quality, F.repeat(F.lit("I"), F.length(seq)))


def orientation_flipped(q1: Column, q2: Column, r1: Column, r2: Column) -> Column:
    return (q1 < q2) != (r1 < r2)
