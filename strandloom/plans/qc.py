"""Queries on read cleaning and read statistics, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions.seq import once
from strandloom.operators import qc, reads
from strandloom.plans.views import A3, A5, ALN, COLLAPSED, READS, SEQS, alignments, collapsed, ham, read, sequences
from strandloom.plans.views import reads as view

_ID = "SELECT sample, doc_id, i, read_id, seq, qual FROM reads"
_LOW = "len(list_filter(string_split(qual, ''), lambda q: q <> '' AND ascii(q) - 33 <= {}))"
_Q = "(SELECT sample, seq, len(seq) AS len, len(seq) - len(replace(seq, 'N', '')) AS nn, len(regexp_replace(seq, '[^GC]', '', 'g')) AS gc, {} AS q5, {} AS q19, {} AS q29 FROM reads)".format(_LOW.format(5), _LOW.format(19), _LOW.format(29))
_HAS5 = f"coalesce(list_bool_or(list_transform(range(8, len(seq)), lambda e: {ham(f'substr(seq, e - least(e, {len(A5)}) + 1, least(e, {len(A5)}))', f'right({chr(39)}{A5}{chr(39)}, least(e, {len(A5)}))')} <= 1)), false)"
_AT3 = f"list_min(list_filter(range(0, len(seq) - 7), lambda p: {ham(f'substr(seq, p + 1, least(len(seq) - p, {len(A3)}))', f'left({chr(39)}{A3}{chr(39)}, least(len(seq) - p, {len(A3)}))')} <= 2))"
_INS = f"t AS (SELECT *, coalesce(left(seq, {_AT3}), '') AS insert_ FROM reads)"
_POLY = "regexp_matches({}, 'A{{7,}}|T{{7,}}|G{{7,}}|C{{7,}}')"
_REASON = f"CASE WHEN {_HAS5} THEN 'adapter5' WHEN len(insert_) < 10 THEN 'insert' WHEN {_POLY.format('insert_')} THEN 'poly' WHEN len(insert_) NOT BETWEEN 16 AND 35 THEN 'length' ELSE 'pass' END"


def _waterfall_slice(spark, d):
    """Clean, collapse and tabulate: the flagship."""
    cut = once(qc.adapter3_trim(view(spark, d), A3), "reason", qc.qc_reason(A3, A5))
    kept = cut.where("reason = 'pass' OR reason = 'insert'").withColumn("seq", F.when(F.col("insert") == "", F.col("seq")).otherwise(F.col("insert")))
    return reads.length_distribution(reads.collapse_reads(kept), 10, 36)


def _report_sql() -> str:
    clean = f"clean AS (SELECT * FROM reads WHERE NOT (0.5 * len(seq) <= {_LOW.format(14)}))"
    stage = """SELECT sample, '{0}' AS stage, count(*) AS reads, CAST(sum(len) AS BIGINT) AS bases, round(100.0::DOUBLE * sum(nn) / sum(len), 4) AS n_percent, round(100.0::DOUBLE * sum(q5) / sum(len), 4) AS low_percent,
      round(100 - 100.0::DOUBLE * sum(q19) / sum(len), 4) AS q20, round(100 - 100.0::DOUBLE * sum(q29) / sum(len), 4) AS q30, round(100.0::DOUBLE * sum(gc) / (sum(len) - sum(nn)), 4) AS gc_percent,
      round(100.0::DOUBLE * (count(*) - count(DISTINCT seq)) / count(*), 4) AS duplication FROM {1} GROUP BY 1"""
    error = """SELECT sample, '{0}' AS stage, round(sum(pow(10.0, -q / 10)), 6) AS error FROM (SELECT sample, p, avg(q) AS q FROM
      (SELECT sample, unnest(range(1, len(qual) + 1)) AS p, unnest(list_transform(string_split(qual, ''), lambda q: ascii(q) - 33)) AS q FROM {1}) GROUP BY 1, 2) GROUP BY 1"""
    both = lambda text, raw, kept: text.format("raw", raw) + " UNION ALL " + text.format("clean", kept)
    return f"""WITH {READS}, {clean}, x AS ({both(stage, _Q, _Q.replace("FROM reads", "FROM clean"))}), e AS ({both(error, "reads", "clean")})
      SELECT x.*, error, CASE WHEN stage = 'clean' THEN (SELECT reads FROM x y WHERE y.sample = x.sample AND y.stage = 'raw') - reads ELSE 0 END AS discarded FROM x JOIN e USING (sample, stage)"""


def _ids(spark, d):
    """SAMPLE_IDX_xN ids over a whole table, every 7th malformed."""
    c = read(spark, d, "documents")
    return c.select(F.when(F.col("doc_id") % 7 == 3, F.concat_ws("_", "source", "doc_id")).otherwise(F.concat(F.col("source"), F.lit("_"), F.col("doc_id"), F.lit("_x"), F.col("n_chars"))).alias("read_id"))


QUERIES = {
    "qc_collapse_lengths": (_waterfall_slice, f"WITH {READS}, {_INS}, r AS (SELECT *, {_REASON} AS reason FROM t), k AS (SELECT sample, CASE WHEN insert_ = '' THEN seq ELSE insert_ END AS seq FROM r WHERE reason IN ('pass', 'insert')), b AS (SELECT len(seq) AS len, count(*) AS n FROM k WHERE len(seq) BETWEEN 10 AND 36 GROUP BY 1) SELECT CAST(g AS INT) AS len, CAST(coalesce(n, 0) AS BIGINT) AS n, round(coalesce(100.0 * n / (SELECT sum(n) FROM b), 0.0)::DOUBLE, 4) AS percent FROM range(10, 37) t(g) LEFT JOIN b ON b.len = g"),
    "reads_per_sample": (lambda s, d: reads.reads_per_sample(_ids(s, d)), "SELECT CASE WHEN doc_id % 7 = 3 THEN '' ELSE source END AS sample, CAST(sum(CASE WHEN doc_id % 7 = 3 THEN 0 ELSE n_chars END) AS BIGINT) AS reads, count(*) FILTER (doc_id % 7 <> 3) AS uniq, count(*) FILTER (doc_id % 7 = 3) AS bad FROM documents GROUP BY 1"),
    "filter_n_rate": (lambda s, d: qc.filter_n_rate(view(s, d)).select("read_id", "seq"), f"WITH {READS} SELECT read_id, seq FROM reads WHERE NOT (0.1 * len(seq) <= len(seq) - len(replace(seq, 'N', '')))"),
    "filter_low_qual": (lambda s, d: qc.filter_low_qual(view(s, d), 14, 0.5).select("read_id", "seq"), f"WITH {READS} SELECT read_id, seq FROM reads WHERE NOT (0.5 * len(seq) <= {_LOW.format(14)})"),
    "clean_header": (lambda s, d: qc.clean_header(view(s, d)).select("read_id", "seq"), f"WITH {READS} SELECT doc_id || '_' || i AS read_id, seq FROM reads"),
    "head_trim": (lambda s, d: qc.head_trim(view(s, d), 20).select("read_id", "seq", "qual"), f"WITH {READS} SELECT read_id, left(seq, 20) AS seq, left(qual, 20) AS qual FROM reads"),
    "adapter5_detect": (lambda s, d: qc.adapter5_detect(view(s, d), A5).select("read_id", "has5"), f"WITH {READS} SELECT read_id, {_HAS5} AS has5 FROM reads"),
    "adapter3_trim": (lambda s, d: qc.adapter3_trim(view(s, d), A3).select("read_id", "insert"), f'WITH {READS}, {_INS} SELECT read_id, insert_ AS "insert" FROM t'),
    "filter_insert": (lambda s, d: qc.filter_insert(qc.adapter3_trim(view(s, d), A3)).select("read_id", "insert"), f'WITH {READS}, {_INS} SELECT read_id, insert_ AS "insert" FROM t WHERE len(insert_) >= 10'),
    "filter_homopolymer": (lambda s, d: qc.filter_homopolymer(view(s, d), 4).select("read_id", "seq"), f"WITH {READS} SELECT read_id, seq FROM reads WHERE NOT regexp_matches(seq, 'A{{4,}}|T{{4,}}|G{{4,}}|C{{4,}}')"),
    "filter_length": (lambda s, d: qc.filter_length(view(s, d), 18, 30).select("read_id", "seq"), f"WITH {READS} SELECT read_id, seq FROM reads WHERE len(seq) BETWEEN 18 AND 30"),
    "qc_waterfall": (lambda s, d: qc.qc_waterfall(view(s, d), A3, A5), f"WITH {READS}, {_INS}, r AS (SELECT {_REASON} AS reason, len(seq) AS n FROM t) SELECT reason, count(*) AS reads, CAST(sum(n) AS BIGINT) AS bases, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM r), 4) AS percent FROM r GROUP BY 1"),
    "adaptor_tool": (lambda s, d: qc.adaptor_tool(view(s, d), A3, A5, 3, 30).select("read_id", "seq"), f"WITH {READS}, {_INS} SELECT read_id, insert_ AS seq FROM t WHERE NOT {_HAS5} AND len(insert_) BETWEEN 3 AND 30"),
    "collapse_reads": (lambda s, d: reads.collapse_reads(view(s, d)), f"WITH {COLLAPSED} SELECT sample, seq, n FROM c"),
    "length_distribution": (lambda s, d: reads.length_distribution(collapsed(s, d), 16, 35), f"WITH {COLLAPSED}, b AS (SELECT len(seq) AS len, CAST(sum(n) AS BIGINT) AS n FROM c WHERE len(seq) BETWEEN 16 AND 35 GROUP BY 1) SELECT CAST(g AS INT) AS len, coalesce(n, 0) AS n, round(coalesce(100.0::DOUBLE * n / (SELECT sum(n) FROM b), 0.0), 4) AS percent FROM range(16, 36) t(g) LEFT JOIN b ON b.len = g"),
    "base_composition": (lambda s, d: qc.base_composition(view(s, d)), "WITH {}, e AS (SELECT unnest(range(1, len(seq) + 1)) AS p, unnest(string_split(seq, '')) AS b FROM reads) SELECT CAST(p AS INT) AS pos, {}, {} FROM e GROUP BY 1".format(READS, ", ".join(f"count(*) FILTER (b = '{b}') AS n_{b.lower()}" for b in "ATGCN"), ", ".join(f"round(100.0::DOUBLE * count(*) FILTER (b = '{b}') / count(*), 4) AS p_{b.lower()}" for b in "ATGCN"))),
    "quality_by_position": (lambda s, d: qc.quality_by_position(view(s, d)), f"WITH {READS}, e AS (SELECT unnest(range(1, len(qual) + 1)) AS p, unnest(list_transform(string_split(qual, ''), lambda q: ascii(q) - 33)) AS q FROM reads) SELECT CAST(p AS INT) AS pos, round(avg(q), 6) AS mean_q, round(100 * pow(10.0, -avg(q) / 10), 6) AS error FROM e GROUP BY 1"),
    "quality_histogram": (lambda s, d: qc.quality_histogram(view(s, d)), f"WITH {READS}, e AS (SELECT unnest(list_transform(string_split(qual, ''), lambda q: ascii(q) - 33)) AS q FROM reads) SELECT CAST(q AS INT) AS q, count(*) AS n FROM e GROUP BY 1"),
    "fastq_summary": (lambda s, d: qc.fastq_summary(view(s, d)), f"WITH {READS} SELECT sample, count(*) AS reads, CAST(sum(len) AS BIGINT) AS bases, round(100.0::DOUBLE * sum(nn) / sum(len), 4) AS n_percent, round(100.0::DOUBLE * sum(q5) / sum(len), 4) AS low_percent, round(100 - 100.0::DOUBLE * sum(q19) / sum(len), 4) AS q20, round(100 - 100.0::DOUBLE * sum(q29) / sum(len), 4) AS q30, round(100.0::DOUBLE * sum(gc) / (sum(len) - sum(nn)), 4) AS gc_percent, round(100.0::DOUBLE * (count(*) - count(DISTINCT seq)) / count(*), 4) AS duplication FROM {_Q} GROUP BY 1"),
    "fastq_report": (lambda s, d: qc.fastq_report(view(s, d), qc.filter_low_qual(view(s, d), 14, 0.5)), _report_sql()),
    "qc_passrate": (lambda s, d: qc.qc_passrate(read(s, d, "orders").select(F.col("o_orderpriority").alias("sample"), (F.col("o_orderstatus") == "F").alias("ok"))), "SELECT o_orderpriority AS sample, count(*) FILTER (o_orderstatus <> 'F') AS filtered, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS passed, round(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'F') / count(*), 2) AS rate FROM orders GROUP BY 1"),
    "uniq_total_stats": (lambda s, d: reads.uniq_total_stats(collapsed(s, d)), f"WITH {COLLAPSED} SELECT sample, CAST(sum(n) AS BIGINT) AS reads, CAST(sum(n * len(seq)) AS BIGINT) AS bases, count(*) AS uniq_reads, CAST(sum(len(seq)) AS BIGINT) AS uniq_bases FROM c GROUP BY 1"),
    "first_base_bias": (lambda s, d: reads.first_base_bias(collapsed(s, d)), "WITH {} SELECT x.sample, CAST(g AS INT) AS len, {} FROM (SELECT DISTINCT sample FROM c) x CROSS JOIN range(18, 31) t(g) LEFT JOIN c ON c.sample = x.sample AND len(c.seq) = g GROUP BY 1, 2".format(COLLAPSED, ", ".join(f"CAST(coalesce(sum(n) FILTER (left(seq, 1) = '{b.replace('U', 'T')}'), 0) AS BIGINT) AS {b.lower()}" for b in "AUCG"))),
    "position_base_bias": (lambda s, d: reads.position_base_bias(collapsed(s, d)), "WITH {}, e AS (SELECT sample, n, unnest(range(1, least(len(seq), 22) + 1)) AS pos, unnest(string_split(left(seq, 22), '')) AS b FROM c) SELECT sample, CAST(pos AS INT) AS pos, {} FROM e GROUP BY 1, 2".format(COLLAPSED, ", ".join(f"CAST(coalesce(sum(n) FILTER (b = '{b.replace('U', 'T')}'), 0) AS BIGINT) AS {b.lower()}" for b in "AUCG"))),
    "expand_multiplicity": (lambda s, d: reads.expand_multiplicity(collapsed(s, d)), f"WITH {COLLAPSED} SELECT sample, seq, n, unnest(range(1, n + 1)) AS copy FROM c"),
    "strand_normalise": (lambda s, d: reads.strand_normalise(view(s, d).select("read_id", "seq", F.when(F.col("i") % 2 == 0, "-").otherwise("+").alias("strand"))), f"WITH {READS} SELECT read_id, CASE WHEN i % 2 = 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq, CASE WHEN i % 2 = 0 THEN '-' ELSE '+' END AS strand FROM reads"),
    "reverse_complement": (lambda s, d: view(s, d).select("read_id", reads.reverse_complement(F.col("seq")).alias("rc")), f"WITH {READS} SELECT read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM reads"),
    "normalise_seq": (lambda s, d: reads.normalise_seq(view(s, d).select("read_id", F.lower(F.translate("seq", "T", "U")).alias("seq"))), f"WITH {READS} SELECT read_id, seq FROM reads WHERE NOT contains(seq, 'N')"),
    "gc_fraction": (lambda s, d: reads.gc_fraction(view(s, d)), "WITH {} SELECT sample, round(avg(len(regexp_replace(seq, '[^GC]', '', 'g'))::DOUBLE / len(seq)), 6) AS mean_share, {} FROM reads GROUP BY 1".format(READS, ", ".join(f"CAST(sum(len(seq) - len(replace(seq, '{b}', ''))) AS BIGINT) AS {b.lower()}" for b in "ACGT"))),
    "share_specific": (lambda s, d: reads.share_specific(collapsed(s, d)), f"WITH {COLLAPSED}, t AS (SELECT sample, count(*) AS u, sum(n) AS t FROM c GROUP BY 1), b AS (SELECT x.sample AS a, y.sample AS b, count(*) AS k, sum(x.n) AS ta, sum(y.n) AS tb FROM c x JOIN c y ON x.seq = y.seq AND x.sample < y.sample GROUP BY 1, 2) SELECT p.sample AS a, q.sample AS b, coalesce(k, 0) AS common_uniq, CAST(coalesce(ta + tb, 0) AS BIGINT) AS common_total, p.u - coalesce(k, 0) AS a_uniq, CAST(p.t - coalesce(ta, 0) AS BIGINT) AS a_total, q.u - coalesce(k, 0) AS b_uniq, CAST(q.t - coalesce(tb, 0) AS BIGINT) AS b_total FROM t p JOIN t q ON p.sample < q.sample LEFT JOIN b ON b.a = p.sample AND b.b = q.sample"),
    "multimap_weight": (lambda s, d: reads.multimap_weight(alignments(s, d)).select("read_id", "k", "m", F.round("weight", 6).alias("weight"), F.round("uniq_weight", 6).alias("uniq_weight")), f"WITH {ALN} SELECT read_id, k, m, round(n::DOUBLE / m, 6) AS weight, round(1.0::DOUBLE / m, 6) AS uniq_weight FROM (SELECT *, count(*) OVER (PARTITION BY read_id) AS m FROM a)"),
    "seq_lengths": (lambda s, d: reads.seq_lengths(sequences(s, d).withColumnRenamed("s", "seq"), "doc_id"), f"WITH {SEQS} SELECT doc_id, CAST(len(s) AS INT) AS len FROM s"),
}
