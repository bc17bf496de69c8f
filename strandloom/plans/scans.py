"""Queries on file scans, each with its SQL: files that Spark derives from the given tables, read by the readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.scratch import new_path
from strandloom.operators import align
from strandloom.plans.align import EXACT, LENGTHS, bench, uniq
from strandloom.plans.views import READS, SEQS, read, reads, sequences
from strandloom.plans.quant import LONG, longs
from strandloom.sources import readers, sinks


def _put(df: DataFrame, value: Column, name: str) -> str:
    """A folder of text files with ``value`` as their lines."""
    path = new_path(df.sparkSession, name)
    df.select(value.alias("value")).write.text(path)
    return path


def _tabs(*columns) -> Column:
    """Tab-separated fields, nulls empty."""
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns])


def fasta(s, d):
    df = sequences(s, d)
    wrapped = F.regexp_replace("s", "(.{60})", "$1\n")
    return readers.read_fasta(s, _put(df, F.concat(F.lit(">"), "doc_id", F.lit(" "), F.coalesce("sample", F.lit("")), F.lit("\n"), F.lower(wrapped)), "fasta"), drop_n=True)


def _wrapped(s, refs, name):
    """A FASTA file of refs (ref, seq) with 60 letters a line."""
    return _put(refs, F.concat(F.lit(">"), "ref", F.lit(" x\n"), F.regexp_replace("seq", "(.{60})", "$1\n")), name)


def tiles(s, d):
    path = _wrapped(s, sequences(s, d).select(F.col("doc_id").alias("ref"), F.col("s").alias("seq")), "tiles")
    return readers.fasta_tiles(s, path, 256, 35)


def tiled_align(s, d):
    return align.exact_align(uniq(s, d), readers.fasta_tiles(s, _wrapped(s, bench(s, d), "references"), 256, max(LENGTHS) - 1), LENGTHS, one=False)


def written_fasta(s, d):
    path = new_path(s, "written-fasta")
    sinks.write_fasta(sequences(s, d).select(F.col("doc_id").alias("id"), F.col("s").alias("seq")), path)
    return readers.read_fasta(s, path).select("id", "seq")


def written_matrix(s, d):
    path = new_path(s, "written-matrix")
    sinks.write_matrix(longs(s, d), SAMPLES, path)
    return s.read.csv(path, sep="\t", header=True, schema=f"id bigint, {', '.join(f'{x} bigint' for x in SAMPLES)}")


def hit_blocks(s, d):
    """A search report of a block for each part; every third part has no hit."""
    found = F.when(F.col("p_size") % 3 == 0, "No Hits Found above Threshold").otherwise(F.col("p_type"))
    path = _put(read(s, d, "part"), F.concat(F.lit("query p"), "p_partkey", F.lit("\n"), found, F.lit("\nComplete")), "hits")
    return readers.read_hit_blocks(s, path)


def fastq(s, d):
    df = reads(s, d)
    path = _put(df, F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), F.translate("qual", "#", "@")), "fastq")
    return readers.read_fastq(s, [path]).select("read_id", "seq", "qual")


def alignments(s, d):
    mism = F.when(F.col("l_linenumber") == 1, F.lit("3:A>C"))
    path = _put(read(s, d, "lineitem"), _tabs("l_orderkey", F.when(F.col("l_linestatus") == "O", "+").otherwise("-"), "l_suppkey", "l_partkey", F.lit("ACGT"), F.lit('"I"I'), "l_linenumber", mism), "alignments")
    return readers.read_alignments(s, path)


def _features(s, d, name, attributes):
    kind = F.when(F.col("p_size") % 2 == 0, "exon").otherwise("gene")
    return _put(read(s, d, "part"), _tabs("p_brand", F.lit("x"), kind, "p_partkey", F.col("p_partkey") + F.col("p_size"), F.lit("."), F.when(F.col("p_size") > 25, "+").otherwise("-"), F.lit("."), attributes), name)


def gtf(s, d):
    attributes = F.concat(F.lit('gene_id "g'), F.col("p_size"), F.lit('"; transcript_id "t'), F.col("p_partkey"), F.lit('";'))
    return readers.read_gtf(s, _features(s, d, "gtf", attributes), "exon").drop("attributes")


def gff(s, d):
    attributes = F.concat(F.lit("ID=g"), F.col("p_partkey"), F.lit(";Name="), F.col("p_type"))
    out = readers.read_gff(s, _features(s, d, "gff", attributes), "gene")
    return out.select("chrom", "feature", "start", "end", "strand", "id", F.col("attr")["Name"].alias("name"))


def gene2go(s, d):
    terms = read(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.concat(F.lit("GO:"), "l_suppkey"))).alias("terms"))
    return readers.read_gene2go(s, _put(terms, F.concat_ws("\t", "l_orderkey", F.when(F.col("l_orderkey") % 7 != 0, F.col("terms"))), "gene2go"))


def blast_tab(s, d):
    li = read(s, d, "lineitem")
    rest = ["l_partkey", "l_suppkey", "l_linenumber"]
    twelve = _tabs("l_orderkey", "l_partkey", F.col("l_discount") * 100, "l_suppkey", "l_linenumber", F.lit(0), *rest, F.lit(7), "l_tax", "l_extendedprice")
    fourteen = _tabs("l_orderkey", "l_suppkey", "l_partkey", "l_suppkey", "l_linenumber", *rest, F.lit(7), "l_tax", "l_extendedprice", "l_discount", F.lit(1), F.lit(0))
    a = readers.read_blast_tab(s, _put(li, twelve, "blast12")).select(F.lit(12).alias("layout"), "qid", "sid", "len", "qstart", "send", "evalue", "score")
    b = readers.read_blast_tab(s, _put(li, fourteen, "blast14"), 14).select(F.lit(14).alias("layout"), "qid", "sid", F.col("alen").alias("len"), "qstart", "send", "evalue", "score")
    return a.unionByName(b)


def _reports(s, d, line, before, after, name):
    """A file for every hundred customers, with a ``line`` for each between ``before`` and ``after``."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda x: x["line"])
    reports = read(s, d, "customer").groupBy(F.floor(F.col("c_custkey") / 100).alias("report")).agg(lines.alias("lines"))
    path = new_path(s, name)
    reports.select("report", F.concat(F.lit(before), F.array_join("lines", "\n"), F.lit(after)).alias("value")).write.partitionBy("report").text(path)
    return path


def blast_xml(s, d):
    """A search report for each part that Spark writes."""
    customer, path = read(s, d, "customer"), new_path(s, "xml")
    named = F.concat(F.lit("q"), "c_custkey")
    customer.select(named.alias("Iteration_query-def"), F.col("c_nationkey").alias("Iteration_stat")).write.format("xml").option("rootTag", "BlastOutput").option("rowTag", "Iteration").save(path)
    ids = customer.where("c_nationkey % 3 = 0").select(named.alias("id"))
    return readers.blast_xml_semi(s, path, ids).select(F.col("Iteration_query-def").alias("query"), F.col("Iteration_stat").alias("stat"))


def mrd(s, d):
    line = F.concat(F.lit("S_"), "l_linenumber", F.lit("_x"), F.col("l_quantity").cast("int"), F.lit("  .acgu"), F.lit(" 0"))
    o = read(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("total"))
    total = F.when(F.col("l_orderkey") % 5 == 0, 0).otherwise(F.col("total"))
    block = F.concat_ws("\n", F.concat(F.lit(">p"), "l_orderkey"), F.concat(F.lit("total read count "), total), F.concat(F.lit("pri_seq  acgu"), F.repeat(F.lit("a"), F.size("lines"))), "lines")
    n = F.aggregate("reads", F.lit(0).cast("long"), lambda x, r: x + r["n"])
    return readers.read_mrd(s, _put(o, block, "mrd")).select("precursor", "total", "pri_seq", F.size("reads").alias("n_reads"), n.alias("sum_n"))


def duplex(s, d):
    return readers.read_duplex_text(s, _put(read(s, d, "lineitem"), F.concat(F.lit("target: p"), "l_partkey", F.lit("\nlength: 21\nmiRNA : s"), "l_suppkey", F.lit("\n")), "duplex"))


def structures(s, d):
    arm = F.col("p_size").cast("int")
    structure = F.concat(F.expr("repeat('(', p_size)"), F.lit("..."), F.expr("repeat(')', p_size)"))
    value = F.concat(F.lit(">p"), "p_partkey", F.lit(" "), "p_brand", F.lit("\n"), F.repeat(F.lit("AC"), arm), F.lit("GGG\n"), structure, F.lit(" ("), F.format_string("%6.2f", -F.col("p_size") / 4), F.lit(")"))
    return readers.read_structures(s, _put(read(s, d, "part"), value, "structures"))


def sections(s, d):
    """What follows the marker is left out."""
    return readers.read_sections(s, _reports(s, d, F.col("c_name"), "# report\n\n", "\n////\nend", "sections"))


def sheet(s, d):
    sample = F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey"))
    group = F.when(F.col("s_suppkey") % 3 != 0, F.lit("g"))
    return readers.sample_sheet(s, _put(read(s, d, "supplier"), _tabs("s_name", sample, group), "sheet"))


_FEATURE = "p AS (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'exon' ELSE 'gene' END AS feature, CAST(p_partkey AS INT) AS \"start\", CAST(p_partkey + p_size AS INT) AS \"end\", CASE WHEN p_size > 25 THEN '+' ELSE '-' END AS strand FROM part)"

SAMPLES = ["A", "N", "R"]
_WIDE = ", ".join(f"CAST(coalesce(sum(value) FILTER (sample = '{x}'), 0) AS BIGINT) AS \"{x}\"" for x in SAMPLES)

QUERIES = {
    "write_fasta": (written_fasta, f"WITH {SEQS} SELECT CAST(doc_id AS VARCHAR) AS id, s AS seq FROM s"),
    "write_matrix": (written_matrix, f"WITH {LONG} SELECT id, {_WIDE} FROM lo GROUP BY 1"),
    "drop_nohit_blocks": (hit_blocks, "SELECT 'query p' || p_partkey || chr(10) || p_type AS block FROM part WHERE p_size % 3 <> 0"),
    "read_fasta": (fasta, f"WITH {SEQS} SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(sample, '') AS description, s AS seq FROM s WHERE NOT contains(s, 'N')"),
    "fasta_tiles": (
        tiles,
        f"""WITH {SEQS}, t AS (SELECT doc_id, s, unnest(range(0, len(s), 256)) AS "at" FROM s)
          SELECT CAST(doc_id AS VARCHAR) AS ref, "at", CAST(least(256, len(s) - "at") AS INT) AS own, substr(s, "at" + 1, 256 + 35) AS seq FROM t""",
    ),
    "tiled_align": (tiled_align, f"WITH {EXACT} SELECT seq, n, CAST(ref AS VARCHAR) AS ref, CAST(pos AS INT) AS pos, strand FROM ex"),
    "read_fastq": (fastq, f"WITH {READS} SELECT read_id, seq, translate(qual, '#', '@') AS qual FROM reads"),
    "read_alignments": (alignments, "SELECT CAST(l_orderkey AS VARCHAR) AS read_id, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CAST(l_suppkey AS VARCHAR) AS ref, CAST(l_partkey AS INT) AS pos, 'ACGT' AS seq, '\"I\"I' AS qual, l_linenumber AS ceil, CASE WHEN l_linenumber = 1 THEN '3:A>C' END AS mism FROM lineitem"),
    "read_gtf": (gtf, f"WITH {_FEATURE} SELECT p_brand AS chrom, 'x' AS source, feature, \"start\", \"end\", '.' AS score, strand, '.' AS frame, 'g' || p_size AS gene_id, 't' || p_partkey AS transcript_id FROM p WHERE feature = 'exon'"),
    "read_gff": (gff, f"WITH {_FEATURE} SELECT p_brand AS chrom, feature, \"start\", \"end\", strand, 'g' || p_partkey AS id, p_type AS name FROM p WHERE feature = 'gene'"),
    "read_gene2go": (gene2go, "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS gene, 'GO:' || l_suppkey AS term FROM lineitem WHERE l_orderkey % 7 <> 0"),
    "read_blast_tab": (blast_tab, "SELECT * FROM (SELECT 12 AS layout, l_orderkey::VARCHAR AS qid, l_partkey::VARCHAR AS sid, l_suppkey::INT AS len, l_partkey::INT AS qstart, 7 AS send, l_tax AS evalue, l_extendedprice AS score FROM lineitem UNION ALL SELECT 14, l_orderkey::VARCHAR, l_partkey::VARCHAR, l_linenumber::INT, l_partkey::INT, 7, l_tax, l_extendedprice FROM lineitem)"),
    "blast_xml_semi": (blast_xml, "SELECT 'q' || c_custkey AS query, CAST(c_nationkey AS BIGINT) AS stat FROM customer WHERE c_nationkey % 3 = 0"),
    "read_mrd": (mrd, "SELECT 'p' || l_orderkey AS precursor, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, 'acgu' || repeat('a', count(*)) AS pri_seq, CAST(count(*) AS INT) AS n_reads, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_n FROM lineitem WHERE l_orderkey % 5 <> 0 GROUP BY l_orderkey HAVING sum(CAST(l_quantity AS BIGINT)) > 0"),
    "read_duplex_text": (duplex, "SELECT DISTINCT 'p' || l_partkey AS target, 's' || l_suppkey AS mirna FROM lineitem"),
    "read_structures": (structures, "SELECT 'p' || p_partkey AS id, repeat('AC', p_size) || 'GGG' AS seq, repeat('(', p_size) || '...' || repeat(')', p_size) AS structure, (-p_size / 4.0)::DOUBLE AS mfe FROM part"),
    "read_sections": (sections, "SELECT CAST(1 + row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey, c_name) AS INT) AS line, c_name AS value FROM customer"),
    "sample_sheet": (sheet, "SELECT s_name AS file, CAST(s_nationkey AS VARCHAR) AS sample, CASE WHEN s_suppkey % 3 <> 0 THEN 'g' END AS grp FROM supplier WHERE s_suppkey % 4 <> 0"),
}
