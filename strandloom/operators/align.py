"""Alignment as joins: reference windows by read length, seeds for mismatches; intervals to sequences; target sites."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.seq import kmers, letters, once, pieces, reverse_complement
from strandloom.functions.seqarrays import WORD, pack
from strandloom.operators.stats import hypergeom_tail


#: The seed that reads and references meet by: its length, and for each number of mismatches how many pieces it is cut into and how
#: many of them must be exact (with v mismatches all but v pieces are).
CORE, PIECES = 18, {0: (1, 1), 1: (3, 2), 2: (5, 3), 3: (6, 3)}


#: Parts that the matures of one name are dealt to when they meet their hairpins.
DEALT = 16


def _letters_mask(places: range) -> int:
    return sum(7 << (3 * (WORD - 1 - i)) for i in places)


def reference_index(refs: DataFrame, least: int, most: int, both: bool = True) -> DataFrame:
    """One row a place and strand of refs (ref, seq), whole or as tiles (ref, at, own, seq) that overlap by at least most - 1 letters:
    ref, strand, edge, room, w0, w1, ...

    The words hold the bases read from the place in the strand's direction; edge: the read's first place (0-based) on plus, the
    place after its last on minus; room: how many bases there are to read, at most ``most``; rows with fewer than ``least`` are left out.
    """
    pad = F.lit(" " * (most - least))
    if "at" not in refs.columns:
        refs = refs.select("ref", F.lit(0).alias("at"), F.length("seq").alias("own"), "seq")
    short = F.length("seq") < F.col("own") + most - 1  # it reaches the reference's end
    begins, n = F.col("at") == 0, F.col("at") + F.length("seq")
    long = refs.where(F.length("seq") >= least).select("ref", n.alias("n"), "at", "own", F.concat(F.when(begins, pad).otherwise(""), "seq", F.when(short, pad).otherwise("")).alias("seq"))
    places = kmers(long, "seq", most, ["ref", "n", "at", "own"]).withColumn("p", F.col("at") + F.col("pos") - 1 - F.when(begins, most - least).otherwise(0))
    places = places.where(F.col("p") < F.col("at") + F.col("own"))
    end = F.col("p") + most
    plus = F.struct(F.lit("+").alias("strand"), F.col("p").alias("edge"), F.least(F.lit(most), F.col("n") - F.col("p")).alias("room"), F.col("kmer").alias("text"))
    minus = F.struct(F.lit("-").alias("strand"), end.alias("edge"), F.least(F.lit(most), end).alias("room"), reverse_complement(F.col("kmer")).alias("text"))
    rows = places.select("ref", "n", F.explode(F.array(plus, minus) if both else F.array(plus)).alias("x")).select("ref", "n", "x.*")
    rows = rows.where((F.col("room") >= least) & (F.col("edge") >= 0) & (F.col("edge") <= F.col("n")))
    return pack(rows.select("ref", "strand", "edge", "room", "text"), "text", -(-most // WORD), "w")


def _packed_reads(reads: DataFrame, words: int) -> DataFrame:
    """Reads as row (all given columns), size, r0, r1, ... and m0, m1, ...: a bit for each letter that the read has."""
    given = reads.select(F.struct(*[F.col(c) for c in reads.columns]).alias("row"), F.coalesce(F.length("seq"), F.lit(0)).alias("size"), F.col("seq").alias("text"))
    ones = [[sum(1 << (3 * (WORD - 1 - i)) for i in range(min(WORD, max(0, size - WORD * k)))) for size in range(WORD * words + 1)] for k in range(words)]
    return pack(given, "text", words, "r").select("*", *[F.get(F.lit(x).cast("array<long>"), F.least("size", F.lit(WORD * words))).alias(f"m{k}") for k, x in enumerate(ones)])


def _unlike(k: int) -> Column:
    """How many letters of a read are unlike the place's, in word k."""
    x = F.col(f"r{k}").bitwiseXOR(F.col(f"w{k}"))
    any_ = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2))
    return F.bit_count(any_.bitwiseAND(F.col(f"m{k}")))


def mismatch_align(reads: DataFrame, refs: DataFrame, lengths: list[int], v: int = 1, both: bool = True) -> DataFrame:
    """Reads (seq, ...) on references (ref, seq) with at most v mismatches: pos (0-based), strand, mism. All hits, none left out.

    The first bases of a read (``CORE``, or the shortest length) are cut into pieces of which some must be exact however the mismatches
    lie; each choice of exact pieces is one key of an equi-join, as packed bits with the choice's number in the lowest. A pair that has more
    exact pieces than that counts at the first choice only. What remains is compared by bits; one index row a place and strand serves reads of all lengths.
    """
    least, most = min(lengths), max(lengths)
    core = min(least, CORE)
    pieces_, exact = PIECES[v] if core >= PIECES[v][0] else (v + 1, 1)
    cuts = [core * i // pieces_ for i in range(pieces_ + 1)]
    masks = [_letters_mask(range(a, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    combos = list(combinations(range(pieces_), exact))
    words = -(-most // WORD)
    keys = lambda word: F.explode(F.array(*[F.col(word).bitwiseAND(F.lit(sum(masks[i] for i in c))).bitwiseOR(F.lit(k).cast("long")) for k, c in enumerate(combos)])).alias("key")
    left = _packed_reads(reads.where(F.length("seq").isin(lengths)), words).select("*", keys("r0"))
    right = reference_index(refs, least, most, both).select("*", keys("w0"))
    unlike = sum((_unlike(k) for k in range(1, words)), _unlike(0))
    # which pieces are exact, as bits, and for each such set the first choice inside it
    x = F.col("r0").bitwiseXOR(F.col("w0"))
    same = sum((F.when(x.bitwiseAND(F.lit(m)) == 0, 1 << i).otherwise(0) for i, m in enumerate(masks)), F.lit(0))
    firsts = [next((k for k, c in enumerate(combos) if all(s >> i & 1 for i in c)), -1) for s in range(1 << pieces_)]
    first = F.get(F.lit(firsts), same) == F.col("key").bitwiseAND(F.lit((1 << 3 * (WORD - CORE)) - 1))
    met = left.join(right, "key").where((_unlike(0) <= v) & (F.col("size") <= F.col("room")) & (unlike <= v) & first)
    start = F.when(F.col("strand") == "+", F.col("edge")).otherwise(F.col("edge") - F.col("size")).cast("int")
    return met.select("row.*", "ref", start.alias("pos"), "strand", unlike.cast("int").alias("mism"))


def exact_align(reads: DataFrame, refs: DataFrame, lengths: list[int], both: bool = True, one: bool = True) -> DataFrame:
    """Reads (seq, ...) on references without mismatch; with ``one`` a read's first hit by reference, place and strand."""
    hits = mismatch_align(reads, refs, lengths, 0, both).drop("mism")
    return hits if not one else first_hit(hits, ["ref", "pos", "strand"])


def mirna_profile(reads: DataFrame, refs: DataFrame, sets: DataFrame, mismatches: int = 0, sizes: tuple[int, int] = (18, 25)) -> DataFrame:
    """Known small RNAs among reads (seq, n; distinct), by set of organisms: set, ref, mism, n, uniq.

    refs: ref, seq; sets: set, ref (a reference may be in several). A read counts once for a reference, at its fewest mismatches.
    """
    hits = mismatch_align(reads.select("seq", "n"), refs, list(range(sizes[0], sizes[1] + 1)), mismatches)
    best = hits.groupBy("ref", "seq", "n").agg(F.min("mism").alias("mism"))
    counts = best.groupBy("ref", "mism").agg(F.sum("n").alias("n"), F.count("*").alias("uniq"))
    return counts.join(sets.select("set", "ref").distinct(), "ref").select("set", "ref", "mism", "n", "uniq")


def first_hit(hits: DataFrame, order: list[str]) -> DataFrame:
    best = F.min(F.struct(*order)).alias("__b")
    return hits.groupBy(*[c for c in hits.columns if c not in order]).agg(best).select(*[c for c in hits.columns if c not in order], "__b.*")


def unmapped(reads: DataFrame, hits: DataFrame) -> DataFrame:
    return reads.join(hits.select("seq").distinct(), "seq", "left_anti")


def unaligned(reads: DataFrame, refs: DataFrame, lengths: list[int], both: bool = True) -> DataFrame:
    """Reads (seq, ...) without an exact place on references (ref, seq, or tiles); those of other lengths have none.

    Reads are made and read once: an anti join with the index rows by their first bases, the rest compared by bits.
    """
    least, most = min(lengths), max(lengths)
    words = -(-most // WORD)
    key = lambda word: F.col(word).bitwiseAND(F.lit(_letters_mask(range(min(least, CORE)))))
    left = _packed_reads(reads, words).withColumn("key", key("r0"))
    right = reference_index(refs, least, most, both).select("room", *[f"w{k}" for k in range(words)], key("w0").alias("place"))
    alike = F.lit(True)
    for k in range(words):
        alike = alike & (_unlike(k) == 0)
    return left.join(right, (F.col("key") == F.col("place")) & F.col("size").isin(lengths) & (F.col("size") <= F.col("room")) & alike, "left_anti").select("row.*")


def feature_sequences(features: DataFrame, genome: DataFrame) -> DataFrame:
    """Sequence of features (chrom, start, end 1-based closed, strand) on genome (chrom, seq); reverse complement on minus."""
    s = F.col("__piece")
    return pieces(features, genome, "chrom", F.col("start"), F.col("end")).select(*features.columns, F.when(F.col("strand") == "-", reverse_complement(s)).otherwise(s).alias("seq"))


def extract_locations(seqs: DataFrame, locs: DataFrame, one_based: bool = True, gap: int = 1, forced: str | None = None) -> DataFrame:
    """Cut locations (id, start, end; end -1 is the end, start > end the reverse complement), every ``gap``-th letter.

    ``forced``: a column of locs whose - or + decides the strand, whatever the order of start and end; null or other values leave it to that.
    """
    o = 0 if one_based else 1
    e = F.when(F.col("end") == -1, F.col("__size")).otherwise(F.col("end") + o)
    s = F.col("start") + o
    j = pieces(locs, seqs, "id", F.least(s, e), F.greatest(s, e))
    back = s > e if forced is None else F.when(F.col(forced).isin("+", "-"), F.col(forced) == "-").otherwise(s > e)
    part = F.when(back, reverse_complement(F.col("__piece"))).otherwise(F.col("__piece"))
    if gap > 1:
        part = F.array_join(F.filter(letters(part), lambda x, i: i % gap == 0), "")
    return j.select(*locs.columns, part.alias("seq"))


def cdna_from_exons(exons: DataFrame, genome: DataFrame) -> DataFrame:
    """Exons (tid, chrom, strand, start, end) in order of start, joined, reverse complement on minus."""
    cut = pieces(exons, genome, "chrom", F.col("start"), F.col("end")).select("tid", "strand", "start", F.col("__piece").alias("x"))
    g = cut.groupBy("tid", "strand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "x"))), lambda e: e["x"]), "").alias("seq"))
    return g.select("tid", F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def utr3_from_cds(cds: DataFrame, seqs: DataFrame, least: int = 16) -> DataFrame:
    """What follows the coding part (before it on minus), if long enough. cds: id, start, end, strand."""
    j = cds.join(seqs, "id")
    u = F.when(F.col("strand") == "-", F.substr("seq", F.lit(1), F.col("start") - 1)).otherwise(F.substr("seq", F.col("end") + 1, F.length("seq")))
    return j.select("id", u.alias("utr")).where(F.length("utr") >= least)


def flank_hits(hits: DataFrame, genome: DataFrame, flank: int = 300) -> DataFrame:
    """Hits (chrom, start, end, strand) with flanks, cut at the ends of the sequence."""
    j = pieces(hits, genome, "chrom", F.greatest(F.lit(1), F.col("start") - flank), F.least("__size", F.col("end") + flank))
    s = F.col("__piece")
    return j.select(*hits.columns, F.col("__from").alias("from"), F.col("__to").alias("to"), F.when(F.col("strand") == "-", reverse_complement(s)).otherwise(s).alias("flanked"))


def extend_utr(utr: DataFrame, upstream: DataFrame | None = None, n: int = 200) -> DataFrame:
    """The last n bases upstream (filled with A on the left), the UTR, and n A."""
    j = utr.join(upstream.select("id", F.col("seq").alias("up")), "id", "left") if upstream is not None else utr.withColumn("up", F.lit(""))
    return j.select("id", F.concat(F.lpad(F.right(F.coalesce("up", F.lit("")), F.lit(n)), n, "A"), "seq", F.lit("A" * n)).alias("seq"))


def region_select(aln: DataFrame, chrom, start: int, end: int) -> DataFrame:
    return aln.where((F.col("chrom") == chrom) & (F.col("beg") < end) & (F.col("end") > start))


def cis_nat(genes: DataFrame, near: int = 100, width: int | None = None) -> DataFrame:
    """Pairs of a plus and a minus gene that overlap or lie near, with their class, overlap and where it lies: beg and end on the
    chromosome, p_from to p_to and m_from to m_to in either gene's own direction (from 1); null without overlap.

    genes: chrom, start, end (1-based closed), strand, id. Genes are entered in bins of ``width`` (or of their mean length with ``near`` on
    either side, so that there are few entries a gene and few candidates beside the pairs); a pair is kept in the first bin that both share. All
    qualifying pairs come back.
    """
    size = F.lit(width) if width else F.greatest(F.lit(1), F.ceil(F.avg(F.col("end") - F.col("start") + 1 + 2 * near)))
    g = genes.crossJoin(F.broadcast(genes.agg(F.any_value(size).alias("__w") if width else size.alias("__w"))))
    g = g.withColumns({"__lo": F.floor((F.col("start") - near) / F.col("__w")), "__hi": F.floor((F.col("end") + near) / F.col("__w"))})
    g = g.withColumn("bin", F.explode(F.sequence("__lo", "__hi")))
    parts = int(genes.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows make many pairs
    side = lambda s, p: g.where(F.col("strand") == s).select("chrom", "bin", *[F.col(c).alias(p + c) for c in ("start", "end", "id", "__lo")]).repartition(parts, "chrom", "bin")
    j = side("+", "p_").join(side("-", "m_"), ["chrom", "bin"]).where(F.col("bin") == F.greatest("p___lo", "m___lo"))
    ps, pe, ms, me = (F.col(c) for c in ("p_start", "p_end", "m_start", "m_end"))
    over = F.least(pe, me) - F.greatest(ps, ms) + 1
    kind = (
        F.when((over > 0) & (ps <= ms) & (pe >= me), "Containing plus").when((over > 0) & (ms <= ps) & (me >= pe), "Containing minus")
        .when((over > 0) & (ps < ms), "Tail to tail").when(over > 0, "Head to head").when(ps < ms, "Nearby tail").otherwise("Nearby head")
    )
    beg, end = F.greatest(ps, ms), F.least(pe, me)
    places = {"beg": beg, "end": end, "p_from": beg - ps + 1, "p_to": end - ps + 1, "m_from": me - end + 1, "m_to": me - beg + 1}
    return j.where(over > -near).select("chrom", "p_id", "m_id", kind.alias("kind"), F.greatest(over, F.lit(0)).alias("overlap"), *[F.when(over > 0, x).alias(c) for c, x in places.items()])


def trans_nat(hits: DataFrame) -> DataFrame:
    """Minus-strand pairs of a self search: HC (gaps under a tenth, half of either gene) or 100nt (no gap, 100 long)."""
    minus = hits.where("sstart > send and qid <> sid")
    hc = (F.col("gaps") != 0) & (F.col("gaps") / F.col("alen") < 0.1) & ((F.col("alen") >= 0.5 * F.col("qlen")) | (F.col("alen") >= 0.5 * F.col("slen")))
    kind = F.when(hc, "HC").when((F.col("gaps") == 0) & (F.col("alen") >= 100), "100nt")
    rows = minus.withColumn("kind", kind).where("kind is not null")
    one = lambda c: F.row_number().over(Window.partitionBy(c).orderBy("line"))
    return rows.withColumn("a", one("qid")).withColumn("b", one("sid")).where("a = 1 or b = 1").drop("a", "b")


def trans_nat_places(pairs: DataFrame, genes: DataFrame) -> DataFrame:
    """Pairs (qid, sid, kind, qstart, qend, sstart > send) whose genes (id, chrom, start, strand) are known: where either part lies on its chromosome."""
    side = lambda p: genes.select(F.col("id").alias(f"{p}id"), *[F.col(c).alias(f"{p}_{c}") for c in ("chrom", "strand")], F.col("start").alias(f"__{p}"))
    j = pairs.join(side("q"), "qid").join(side("s"), "sid")
    place = {"q_beg": ("qstart", "__q"), "q_end": ("qend", "__q"), "s_beg": ("send", "__s"), "s_end": ("sstart", "__s")}
    return j.withColumns({k: F.col(a) + F.col(b) - 1 for k, (a, b) in place.items()}).drop("__q", "__s")


def random_site(utr: DataFrame, width: int = 22) -> DataFrame:
    """One pseudo-random window per UTR, fixed by its id."""
    h = F.conv(F.substring(F.md5(F.col("utr").cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    at = utr.where(F.length("seq") >= width).select("utr", "seq", (h % (F.length("seq") - width + 1) + 1).alias("pos"))
    return at.select("utr", "pos", F.substr("seq", F.col("pos").cast("int"), F.lit(width)).alias("site"))


def duplex_pvalue(df: DataFrame, xi: float, theta: float, e_max: float = -10, p_max: float = 0.05) -> DataFrame:
    """Extreme-value p of an energy normalised by the lengths m and n; kept up to e_max and p_max."""
    en = F.col("energy") / F.ln(F.col("m") * F.col("n"))
    return df.withColumn("p", 1 - F.exp(-F.exp(-(-en - xi) / theta))).where((F.col("energy") <= e_max) & (F.col("p") <= p_max))


def hamming_stats(df: DataFrame) -> DataFrame:
    """Mismatches of a and b, those that are wobbles (C/T, A/G), and whether the last place differs."""
    pairs = F.filter(F.zip_with(letters(F.col("a")), letters(F.col("b")), lambda x, y: F.concat(x, y)), lambda p: p.isNotNull() & (F.substring(p, 1, 1) != F.substring(p, 2, 1)))
    return df.withColumn("mism", F.size(pairs)).withColumn("wobbles", F.size(F.filter(pairs, lambda p: p.isin("CT", "TC", "AG", "GA")))).withColumn("last", F.right("a", F.lit(1)) != F.right("b", F.lit(1)))


def name_compat_pairs(mature: DataFrame, hairpin: DataFrame) -> DataFrame:
    """Matures and hairpins whose ids, bared of -5p, -3p, * and .n, hold one another, whatever the case; repeated sequences first go.

    The family (letters and first number) makes it an equi-join of the distinct names; what they pair is then dealt out, each family
    over many tasks, and joined with the rows.
    """
    bare = lambda c: F.lower(F.regexp_replace(c, r"(-[35]p|\*|\.\d+)+$", ""))
    fam = lambda c: F.regexp_extract(bare(c), r"(mir-?\d+)", 1)
    m = mature.groupBy("seq").agg(F.min("id").alias("mature")).select("mature", bare("mature").alias("x"), fam("mature").alias("f"), F.pmod(F.xxhash64("seq"), F.lit(DEALT)).alias("deal"))
    h = hairpin.select(F.col("id").alias("hairpin"), bare("id").alias("y"), fam("id").alias("f"))
    names = m.select("x", "f").distinct().join(h.select("y", "f").distinct(), "f").where(F.col("x").contains(F.col("y")) | F.col("y").contains(F.col("x"))).select("x", "y")
    parts = int(mature.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows make many pairs
    left = m.join(names, "x").select("mature", "y", "deal").repartition(parts, "y", "deal")
    right = h.select("hairpin", "y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEALT - 1).cast("long"))).alias("deal")).repartition(parts, "y", "deal")
    return left.join(right, ["y", "deal"]).select("mature", "hairpin")


def phase_register(aln: DataFrame, register: int = 21, width: int = 252) -> DataFrame:
    """Per window: positions, and those on the fullest 21-nt register. aln: chrom, pos."""
    p = aln.select("chrom", "pos").distinct().withColumn("w", F.floor(F.col("pos") / width))
    by = p.groupBy("chrom", "w", (F.col("pos") % register).alias("r")).agg(F.count("*").alias("k"))
    return by.groupBy("chrom", "w").agg(F.sum("k").alias("positions"), F.max("k").alias("phased"))


def phase_windows(aln: DataFrame, abundance: int = 2, most_p: float = 0.001, lengths: tuple[int, int] = (20, 26), register: int = 21, width: int = 252) -> DataFrame:
    """Windows that begin at a read's position and are phased on it: chrom, start, positions, phased, p.

    aln: chrom, pos, len, n. Reads of the lengths count, at positions of at least ``abundance`` reads. p is the
    hypergeometric tail of so many of the window's positions on the register of its first one; windows up to ``most_p``
    are kept. No border between windows splits a locus.
    """
    p = aln.where(F.col("len").between(*lengths)).groupBy("chrom", "pos").agg(F.sum("n").alias("n")).where(F.col("n") >= abundance).select("chrom", "pos", F.floor(F.col("pos") / width).alias("bin"))
    first = p.select("chrom", F.col("pos").alias("start"), F.explode(F.array("bin", F.col("bin") + 1)).alias("bin"))
    j = p.join(first, ["chrom", "bin"]).withColumn("at", F.col("pos") - F.col("start")).where((F.col("at") >= 0) & (F.col("at") < width))
    w = j.groupBy("chrom", "start").agg(F.count("*").alias("positions"), F.count_if(F.col("at") % register == 0).alias("phased"))
    # a draw of all positions from the window's places, of which one in register is good
    w = w.withColumn("slots", F.lit((width - 1) // register + 1)).withColumn("places", F.lit(width))
    return hypergeom_tail(w, "phased", "positions", "slots", "places").where(F.col("p") <= most_p).select("chrom", "start", "positions", "phased", F.round("p", 10).alias("p"))
