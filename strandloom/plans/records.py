"""Queries on nested records and reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions.seqarrays import cut
from strandloom.operators import records as r
from strandloom.plans.align import genome, ids
from strandloom.plans.views import ALN, SEQS, alignments, read, sequences


def _edits(s, d):
    """The sequences cut into edited reads of 18 bases (the last may be shorter); five in a row are reads of one mature, each one place further."""
    x = sequences(s, d).select("sample", F.posexplode(cut(F.col("s"), F.lit(18))).alias("o", "s"), "doc_id").withColumn("beg", F.col("o") % 5)
    return x.select(F.col("sample").alias("precursor"), F.concat(F.lit("m"), F.floor(F.col("o") / 5)).alias("mature"), "beg", F.replace("s", F.lit("N"), F.lit("A")).alias("seq"), F.lit("ACGTACGTACGTACGTACGTAC").alias("ref"), (F.col("doc_id") % 5 + 1).alias("n"))


def _mrd(s, d):
    p = ids(s, d).select(F.col("id").alias("precursor"), "seq")
    w = p.select("precursor", F.explode(F.array(F.struct(F.lit("M").alias("kind"), F.lit(5).alias("beg"), F.lit(26).alias("end")), F.struct(F.lit("S").alias("kind"), F.lit(35).alias("beg"), F.lit(56).alias("end")))).alias("w")).select("precursor", "w.*")
    x = p.select("precursor", F.posexplode(F.regexp_extract_all("seq", F.lit("[A-Z]{1,10}"), F.lit(0))).alias("o", "q")).withColumn("beg", 10 * F.col("o"))
    x = x.select("precursor", "beg", F.regexp_replace("q", ".$", "A").alias("seq"), (F.col("precursor") % 4 + F.col("beg") + 1).alias("n"))
    return r.mrd_assemble(p, w, x).select("precursor", "total", "mask", "pri_seq", F.array_join(F.transform("reads", lambda q: F.concat_ws(":", q["beg"], q["end"], q["aligned"], q["n"])), " ").alias("reads"))


def _parts(s, d):
    return read(s, d, "part")


def _go(s, d):
    p = _parts(s, d)
    g = p.select(F.col("p_brand").alias("gene"), F.concat("p_type", F.when(F.col("p_size") == 7, "?").otherwise("")).alias("term"))
    t = p.select(F.col("p_type").alias("term"), F.lower("p_type").alias("name"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("namespace")).distinct()
    return r.go_class_table(g, t, ["STANDARD", "SMALL"])


def _packed(s, d):
    return read(s, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("id")).agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")), "|").alias("genes"), F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.when(k % 4 == 0, "NA").otherwise(F.concat(F.lit("K"), (k % 3).cast("string")))), "|").alias("kos"))


def _terms(s, d):
    a = read(s, d, "orders").where("o_orderkey % 4 <> 0").select(F.col("o_orderkey").cast("string").alias("gene"), F.concat(F.lit("K"), F.col("o_orderkey") % 3).alias("ko"), F.col("o_orderstatus").alias("symbol"))
    return r.term_ids(_packed(s, d).select("id", "genes"), a, ["11", "21"])


def _loci(s, d):
    p = _parts(s, d)
    return p.select(F.col("p_partkey").alias("chrom"), (F.col("p_size") * 3 + 1).alias("start"), (F.col("p_size") * 3 + 63).alias("end"), (F.col("p_partkey") % 12).alias("phased"), (F.col("p_size") / 2e6).alias("p"))


def _report(s, d):
    p = _parts(s, d)
    c = read(s, d, "lineitem").groupBy((F.col("l_partkey") % 400).alias("m")).agg(F.count("*").alias("n")).select(F.concat(F.lit("m"), "m").alias("mature"), "n")
    pairs = p.select(F.concat(F.lit("m"), "p_partkey").alias("mature"), F.concat(F.lit("h"), F.col("p_partkey") % 50).alias("hairpin"))
    h = p.select(F.concat(F.lit("h"), "p_partkey").alias("hairpin"), F.col("p_name").alias("seq"))
    m = p.select(F.concat(F.lit("m"), "p_partkey").alias("mature"), F.col("p_brand").alias("seq"))
    st = p.select(F.concat(F.lit("h"), "p_partkey").alias("hairpin"), (-F.col("p_size")).alias("mfe"), F.col("p_partkey").alias("pos"))
    return c, pairs, h, m, st


def _cand(s, d):
    """Loci of the orders' reads; energies and paired bases, which need folding, by supplier."""
    loci = r.hairpin_loci(_stacked(s, d), genome(s, d), (18, 22), 4)
    c = F.col("s_nationkey")
    folds = read(s, d, "supplier").select(F.col("s_suppkey").alias("chrom"), (-c - 20).alias("energy"), (F.lit(14) + c % 9).alias("paired"))
    return loci.join(folds, "chrom")


_CNT = "c AS (SELECT 'm' || (l_partkey % 400) AS mature, count(*) AS n FROM lineitem GROUP BY 1), rp AS (SELECT c.mature, c.n, coalesce(CASE WHEN p.p_partkey IS NOT NULL THEN 'h' || (p.p_partkey % 50) END, '--') AS hairpin, coalesce(h.p_name, '--') AS hairpin_seq, coalesce(p.p_brand, '--') AS mature_seq, p.p_partkey % 50 AS hp, h.p_size, h.p_partkey AS hk FROM c LEFT JOIN part p ON c.mature = 'm' || p.p_partkey LEFT JOIN part h ON h.p_partkey = p.p_partkey % 50)"
_RC = "reverse(translate({}, 'ACGT', 'TGCA'))"

def _stacked(s, d):
    """Alignments of reads of 18 to 24 bases: orders as reads, suppliers' documents as chromosomes."""
    a = alignments(s, d)
    return a.select(F.col("ref").alias("chrom"), "strand", F.col("pos").alias("beg"), (F.col("pos") + 17 + F.col("k").cast("int")).alias("end"), F.col("read_id").alias("read"), "n")


STACKS = f"""WITH {SEQS}, {ALN}, f AS (SELECT read_id FROM a GROUP BY 1 HAVING count(*) <= 4),
  p AS (SELECT ref, strand, pos, CAST(sum(n) AS BIGINT) AS height, max(pos + 17 + k) AS e FROM a SEMI JOIN f USING (read_id) GROUP BY 1, 2, 3),
  w AS (
    SELECT *, max(height) OVER (PARTITION BY ref, strand ORDER BY pos RANGE BETWEEN 70 PRECEDING AND 70 FOLLOWING) AS top,
      max(height) OVER (PARTITION BY ref, strand ORDER BY pos RANGE BETWEEN 70 PRECEDING AND 1 PRECEDING) AS before FROM p
  ),
  q AS (SELECT * FROM w WHERE height = top AND coalesce(before, 0) < height),
  c AS (SELECT height, sum(count(*)) OVER (ORDER BY height DESC) AS upto FROM q GROUP BY 1),
  z AS (SELECT ref, strand, greatest(0, pos - 70) AS a, least(len(s), e + 70) AS b, s FROM q JOIN s ON s.doc_id = ref WHERE height >= (SELECT min(height) FROM c WHERE upto <= 3000) AND pos < len(s))
  SELECT ref AS chrom, CAST(a AS INT) AS "from", CAST(b AS INT) AS "to", strand, CASE WHEN strand = '-' THEN {_RC.format('substr(s, a + 1, b - a)')} ELSE substr(s, a + 1, b - a) END AS seq FROM z"""


_PICKS = ", ".join(
    f"p{i} AS (SELECT l.locus, min(l.e) AS e FROM l" + (f" JOIN p{i - 1} p ON p.locus = l.locus AND l.beg >= p.e" if i else "") + " GROUP BY 1)" for i in range(4)
)
_PICKED = " UNION ALL ".join(f"SELECT locus FROM p{i}" for i in range(4))
LOCI = f"""WITH {SEQS}, {ALN},
  r AS (SELECT ref AS chrom, strand, pos AS beg, CAST(pos + 17 + k AS INT) AS e, read_id, n, count(*) OVER (PARTITION BY read_id) AS hits FROM a),
  f AS (SELECT * FROM r WHERE e - beg BETWEEN 18 AND 22),
  u AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY beg, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS upto FROM (SELECT DISTINCT chrom, beg, e FROM f)),
  l AS (
    SELECT *, sum(CASE WHEN upto IS NULL OR beg - upto > 4 THEN 1 ELSE 0 END) OVER (ORDER BY chrom, beg, e ROWS UNBOUNDED PRECEDING) AS locus,
      sum(CASE WHEN upto IS NULL OR beg >= upto THEN 1 ELSE 0 END) OVER (ORDER BY chrom, beg, e ROWS UNBOUNDED PRECEDING) AS run FROM u
  ),
  o AS (SELECT locus, max(w) AS overlap FROM (SELECT locus, run, max(e) - min(beg) AS w FROM l GROUP BY 1, 2) GROUP BY 1),
  {_PICKS}, i AS (SELECT locus, count(*) AS islands FROM ({_PICKED}) GROUP BY 1),
  g AS (SELECT f.*, locus, row_number() OVER (PARTITION BY locus ORDER BY n DESC, read_id, strand, f.beg, f.e) AS k FROM f JOIN l USING (chrom, beg, e)),
  b AS (
    SELECT g.locus, chrom, min(beg) AS beg, max(e) AS "end", CAST(sum(n) AS BIGINT) AS abundance, coalesce(sum(n) FILTER (strand = '+'), 0) AS plus,
      max(hits) FILTER (k = 1) AS hits, max(beg) FILTER (k = 1) AS at_, max(e) FILTER (k = 1) AS to_ FROM g GROUP BY 1, 2
  ),
  loci AS (
    SELECT chrom, beg, "end", CASE WHEN plus >= abundance - plus THEN '+' ELSE '-' END AS strand, abundance, hits, greatest(plus, abundance - plus) / abundance::DOUBLE AS oriented,
      islands, CAST(overlap AS INT) AS overlap,
      CASE WHEN len(substr(s, at_ + 1, to_ - at_)) > 0 THEN len(regexp_replace(substr(s, at_ + 1, to_ - at_), '[^GC]', '', 'g')) / len(substr(s, at_ + 1, to_ - at_))::DOUBLE END AS gc
    FROM b JOIN o USING (locus) JOIN i USING (locus) LEFT JOIN s ON s.doc_id = chrom
  )"""


QUERIES = {
    "rfam_compose": (lambda s, d: r.rfam_compose(_parts(s, d).select(F.concat(F.lit("RF;"), F.split_part("p_type", F.lit(" "), F.lit(1)), F.lit(";x:"), "p_brand").alias("ref"), F.col("p_size").cast("long").alias("n")), 1000000), "WITH b AS (SELECT split_part(p_type, ' ', 1) AS class, p_brand AS species, CAST(sum(p_size) AS BIGINT) AS n FROM part GROUP BY 1, 2) SELECT class, species, n, round(100.0::DOUBLE * n / 1000000, 4) AS of_total, round(100.0::DOUBLE * n / (SELECT sum(n) FROM b), 4) AS of_mapped FROM b"),
    "nt_edit_sites": (lambda s, d: r.nt_edit_sites(_edits(s, d)), f"WITH {SEQS}, h AS (SELECT sample, doc_id % 5 + 1 AS n, s, unnest(range(0, (len(s) + 17) // 18)) AS o FROM s), i AS (SELECT sample, 'm' || (o // 5) AS mature, n, o % 5 AS beg, translate(substr(s, 18 * o + 1, 18), 'N', 'A') AS q FROM h), e AS (SELECT sample, mature, n, beg + p - 1 AS pos, substr('ACGTACGTACGTACGTACGTAC', beg + p, 1) AS a, substr(q, p, 1) AS b FROM (SELECT *, unnest(range(1, len(q) + 1)) AS p FROM i)), c AS (SELECT sample, mature, pos, sum(n) AS coverage FROM e GROUP BY 1, 2, 3), d AS (SELECT sample, mature, pos, a || '->' || b AS sub, sum(n) AS edited FROM e WHERE a <> b GROUP BY 1, 2, 3, 4) SELECT sample AS precursor, mature, CAST(pos AS INT) AS pos, sub, CAST(edited AS BIGINT) AS edited, CAST(coverage AS BIGINT) AS coverage, round(100.0::DOUBLE * edited / coverage, 4) AS percent FROM d JOIN c USING (sample, mature, pos)"),
    "mrd_assemble": (_mrd, f"WITH {SEQS}, p AS (SELECT doc_id AS precursor, s AS q FROM s), x AS (SELECT precursor, w, b, left(w, len(w) - 1) || 'A' AS t, precursor % 4 + b + 1 AS n FROM (SELECT precursor, b, substr(q, b + 1, 10) AS w FROM (SELECT *, unnest(range(0, len(q), 10)) AS b FROM p))), y AS (SELECT precursor, b, n, len(w) AS l, array_to_string(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN substr(t, i, 1) = substr(w, i, 1) THEN lower(substr(t, i, 1)) ELSE substr(t, i, 1) END), '') AS al FROM x) SELECT precursor, CAST(sum(n) AS BIGINT) AS total, left(repeat('f', 5) || repeat('M', 22) || repeat('l', 8) || repeat('S', 22) || repeat('f', any_value(len(q))), any_value(len(q))) AS mask, any_value(q) AS pri_seq, string_agg(b || ':' || (b + l - 1) || ':' || al || ':' || n, ' ' ORDER BY b) AS reads FROM y JOIN p USING (precursor) GROUP BY precursor"),
    "go_class_table": (_go, "WITH j AS (SELECT p_brand AS gene, p_type || CASE WHEN p_size = 7 THEN '?' ELSE '' END AS term, CASE WHEN p_size <> 7 THEN split_part(p_type, ' ', 1) END AS ns, lower(p_type) AS name FROM part) SELECT gene, {}, count(*) FILTER (ns IS NULL) AS unknown FROM j GROUP BY 1".format(", ".join(f"coalesce(string_agg(DISTINCT {c}, '//' ORDER BY {c}) FILTER (ns = '{n}'), '--') AS {n}_{k}" for n in ("STANDARD", "SMALL") for c, k in (("term", "ids"), ("name", "names"))))),
    "nat_table_split": (lambda s, d: r.nat_table_split(read(s, d, "lineitem").select(F.when(F.col("l_linenumber") == 1, "cis").otherwise("trans").alias("kind"), (F.col("l_partkey") % 97).alias("a"), (F.col("l_suppkey") % 89).alias("b")), sequences(s, d).select(F.col("doc_id").alias("id"), F.col("s").alias("seq"))), f"WITH {SEQS}, k AS (SELECT CASE WHEN l_linenumber = 1 THEN 'cis' ELSE 'trans' END AS kind, l_partkey % 97 AS a, l_suppkey % 89 AS b FROM lineitem), u AS (SELECT kind, a AS id FROM k UNION SELECT kind, b FROM k) SELECT kind, id, s AS seq FROM u JOIN s ON doc_id = id"),
    "phased_loci": (lambda s, d: r.phased_loci(_loci(s, d), genome(s, d)), f"WITH {SEQS}, l AS (SELECT p_partkey AS chrom, p_size * 3 + 1 AS a, p_size * 3 + 63 AS b FROM part WHERE p_size / 2e6 < 1e-5 AND p_partkey % 12 > 5) SELECT chrom, CAST(a AS INT) AS start, CAST(least(b, len(s)) AS INT) AS \"end\", substr(s, a, least(b, len(s)) - a + 1) AS seq FROM l JOIN s ON doc_id = chrom WHERE least(b, len(s)) >= a"),
    "term_ids": (_terms, "WITH o AS (SELECT o_custkey::VARCHAR AS id, o_orderkey AS k, o_orderstatus AS st FROM orders WHERE o_custkey NOT IN (11, 21)) SELECT id, string_agg(k::VARCHAR, '|' ORDER BY k) AS gene, string_agg(CASE WHEN k % 4 = 0 THEN 'NA' ELSE 'K' || (k % 3) END, '|' ORDER BY k) AS ko, string_agg(CASE WHEN k % 4 = 0 THEN 'NA' ELSE st END, '|' ORDER BY k) AS symbol FROM o GROUP BY 1"),
    "ko_gene_groups": (lambda s, d: r.ko_gene_groups(_packed(s, d)), "SELECT o_custkey::VARCHAR AS id, 'K' || (o_orderkey % 3) AS ko, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR) AS genes FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1, 2"),
    "hairpin_mature_report": (lambda s, d: r.hairpin_mature_report(*_report(s, d)[:4]), f"WITH {_CNT} SELECT mature, n, hairpin, hairpin_seq, mature_seq, '--' AS mfe, '--' AS pos FROM rp"),
    "novel_report": (lambda s, d: r.hairpin_mature_report(*_report(s, d)), f"WITH {_CNT} SELECT mature, n, hairpin, hairpin_seq, mature_seq, coalesce((-p_size)::VARCHAR, '--') AS mfe, coalesce(hk::VARCHAR, '--') AS pos FROM rp"),
    "novel_dedup": (lambda s, d: r.novel_dedup(_parts(s, d).select(F.col("p_type").alias("seq"), F.col("p_brand").alias("star"), F.col("p_size").alias("score"), F.col("p_partkey").alias("id"))), "WITH f AS (SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) = 1) SELECT p_partkey AS id, 'mature' AS kind, p_type AS seq FROM f UNION ALL SELECT p_partkey, 'star', p_brand FROM f"),
    "hairpin_candidate_filter": (
        lambda s, d: r.hairpin_candidate_filter(_cand(s, d), oriented=0.6, hits=4).withColumns({"gc": F.round("gc", 6), "oriented": F.round("oriented", 6)}),
        f"""{LOCI} SELECT chrom, beg, "end", strand, abundance, hits, round(oriented, 6) AS oriented, islands, overlap, round(gc, 6) AS gc, energy, paired
  FROM loci JOIN (SELECT s_suppkey AS chrom, -s_nationkey - 20 AS energy, 14 + s_nationkey % 9 AS paired FROM supplier) USING (chrom)
  WHERE abundance >= 5 AND hits <= 4 AND oriented >= 0.6 AND islands <= 3 AND overlap <= 70 AND gc >= 0.1 AND energy <= -25 AND paired >= 17""",
    ),
    "hairpin_loci": (
        lambda s, d: r.hairpin_loci(_stacked(s, d), genome(s, d), (18, 22), 4).withColumns({"gc": F.round("gc", 6), "oriented": F.round("oriented", 6)}),
        f'{LOCI} SELECT chrom, beg, "end", strand, abundance, hits, round(oriented, 6) AS oriented, islands, overlap, round(gc, 6) AS gc FROM loci',
    ),
    "precursor_stack_excise": (lambda s, d: r.precursor_stack_excise(r.read_stacks(_stacked(s, d), 4, 70, 3000), genome(s, d)), STACKS),
}
