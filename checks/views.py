"""Metagenomics-shaped views over the TPC-H-like test tables.

The text is the same for Spark and DuckDB except for the marked spots in DIALECT. Every view reads
whole tables, so its rows grow with them. A view may use earlier ones.
"""

import re

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Bytes of a table's files for one task: a row becomes one alignment, or hundreds of k-mers.
DEALT = {"events": 1 << 20, "lineitem": 8 << 20, "part": 1 << 20, "customer": 1 << 18, "supplier": 1 << 16}

DIALECT = {
    "spark": {"mates": "lateral view explode(array(1, 2)) t as m", "str": "string"},
    "duckdb": {"mates": "cross join (values (1), (2)) t(m)", "str": "varchar"},
}

VIEWS = {
    # 96-base fragments (mates overlap by 32) for one event in four, else 160; some fragments repeat.
    "frag_v": """
select e.event_id, e.event_type, e.user_id,
  translate(concat(
    md5(concat(cast(sid as varchar(20)), ':a')),
    md5(concat(cast(sid as varchar(20)), ':b')),
    md5(concat(cast(sid as varchar(20)), ':c')),
    case when e.event_id % 4 = 0 then '' else md5(concat(cast(sid as varchar(20)), ':d')) end,
    case when e.event_id % 4 = 0 then '' else md5(concat(cast(sid as varchar(20)), ':e')) end
  ), '0123456789abcdef', 'ACGTACGTACGTACGT') as frag
from (select *, case when event_id % 50 = 1 then 1 else event_id end as sid from events) e""",
    "reads_v": """
select event_type as sample, event_id as pair_id, m as mate,
  case when m = 1 and event_id % 5 = 0 then concat(substr(frag, 1, 44), 'AGATCGGAAGAGCACACGTC')
       when m = 1 and event_id % 7 = 0 then concat('GTTCAGAGTTCTACAGTCCGACGATCACGTTGCATGCAAT', substr(frag, 41, 24))
       when m = 1 and event_id % 11 = 0 then concat(substr(frag, 1, 20), 'N', substr(frag, 22, 43))
       when m = 1 then substr(frag, 1, 64)
       else translate(reverse(substr(frag, length(frag) - 63, 64)), 'ACGT', 'TGCA') end as seq,
  translate(concat(md5(concat(cast(event_id as varchar(20)), ':q1:', cast(m as varchar(2)))),
                   md5(concat(cast(event_id as varchar(20)), ':q2:', cast(m as varchar(2))))),
            '0123456789abcdef', '#&)+-/1368:<>?BI') as qual
from frag_v {mates}""",
    "adapters_v": "select 'adapter1' as ref_id, 'AGATCGGAAGAGCACACGTC' as seq",
    "artifacts_v": "select 'artifact1' as ref_id, 'GTTCAGAGTTCTACAGTCCGACGATCACGTTGCATGCAAT' as seq",
    # Spans on CDS of 400 bases; the start window differs per CDS, so coverage does too.
    "aln_v": """
select l_returnflag as sample, concat('c', cast(l_partkey as varchar(20))) as rname,
  concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20))) as qname,
  (l_orderkey * 3 + l_suppkey * 13 + l_linenumber * 7) % (1 + (l_partkey % 200) * 37 % 290) as start0,
  (l_orderkey * 3 + l_suppkey * 13 + l_linenumber * 7) % (1 + (l_partkey % 200) * 37 % 290) + 60 + cast(l_quantity as bigint) as end0
from lineitem""",
    "cds_v": "select concat('c', cast(p_partkey as varchar(20))) as rname, cast(400 as bigint) as length from part",
    "ann_v": """
select concat('c', cast(p_partkey as varchar(20))) as cds, concat(p_brand, '.', cast(p_partkey as varchar(20))) as seed_orth,
  case when p_partkey % 4 = 3 then null
       when p_partkey % 3 = 0 then concat('4.2.1.', cast(p_size % 12 as varchar(4)), ',1.3.8.', cast(p_partkey % 5 as varchar(4)))
       when p_partkey % 7 = 0 then concat('4.2.1.', cast(p_size % 12 as varchar(4)), ',2.8.3.', cast(1 + p_partkey % 60 as varchar(4)))
       else concat('4.2.1.', cast(p_size % 12 as varchar(4))) end as ec,
  case when p_partkey % 5 = 1 then null
       else concat('ko:K0000', cast(p_partkey % 10 as varchar(4)), ',ko:K0001', cast(p_partkey % 7 as varchar(4))) end as kegg_ko,
  case when p_partkey % 6 = 2 then null
       else concat('map0065', cast(p_partkey % 4 as varchar(4)), ',ko0065', cast(p_partkey % 4 as varchar(4))) end as kegg_pwy,
  case when p_partkey % 6 = 0 then null else concat('Gene', cast(p_partkey % 15 as varchar(4))) end as protein_name
from part where p_size > 4""",
    "tgt_v": """
select case when r_regionkey = 0 then 'All' else r_name end as pathway,
  case when n_nationkey % 6 = 5 then concat('4.2.1.', cast(n_nationkey % 16 as varchar(4)), ',1.3.8.', cast(n_nationkey % 5 as varchar(4)))
       when n_nationkey % 10 = 9 then concat('4.2.1.', cast(n_nationkey % 16 as varchar(4)), ',2.8.3._')
       else concat('4.2.1.', cast(n_nationkey % 16 as varchar(4))) end as ec,
  case when n_nationkey % 4 = 1 then null else concat('K0000', cast(n_nationkey % 10 as varchar(4))) end as ko,
  concat('gene', cast(n_nationkey % 8 as varchar(4))) as short_name,
  concat('ec0065', cast(n_nationkey % 3 as varchar(4))) as pwy
from nation join region on n_regionkey = r_regionkey""",
    "genes_v": """
select concat('g', cast(s_suppkey as varchar(20))) as gene, 240 + (s_suppkey % 40) * 10 as gene_length,
  concat('class', cast(s_nationkey % 5 as varchar(4))) as class, concat('mech', cast(s_nationkey as varchar(4))) as mechanism,
  concat('grp', cast(s_suppkey % 50 as varchar(20))) as grp,
  substr(repeat(translate(concat(
    md5(concat(cast(s_suppkey as varchar(20)), ':g1')), md5(concat(cast(s_suppkey as varchar(20)), ':g2')),
    md5(concat(cast(s_suppkey as varchar(20)), ':g3')), md5(concat(cast(s_suppkey as varchar(20)), ':g4'))),
    '0123456789abcdef', 'ACGTACGTACGTACGT'), 5), 1, cast(240 + (s_suppkey % 40) * 10 as int)) as gene_seq
from supplier""",
    # SAM-like rows; bases equal the gene except planted substitutions at offsets 11 and 30.
    "hits_v": """
select sample, qname, flag, rname, pos, '64M' as cigar, base_quality_sum,
  (case when qname % 3 = 0 then 1 else 0 end) + (case when qname % 5 = 0 then 1 else 0 end) as nm,
  concat(substr(s, 1, 10),
         case when qname % 3 = 0 then translate(substr(s, 11, 1), 'ACGT', 'TGCA') else substr(s, 11, 1) end,
         substr(s, 12, 18),
         case when qname % 5 = 0 then translate(substr(s, 30, 1), 'ACGT', 'TGCA') else substr(s, 30, 1) end,
         substr(s, 31, 34)) as seq
from (
  select event_type as sample, event_id as qname,
    case when event_id % 8 = 0 then 77 when event_id % 8 = 1 then 141
         when event_id % 8 = 2 then 69 when event_id % 8 = 3 then 16
         when event_id % 8 = 4 then 256 else 0 end as flag,
    gene as rname, 1 + ((event_id * 13) % 20) * 9 as pos,
    cast(round(value * 100) as bigint) as base_quality_sum,
    substr(gene_seq, cast(1 + ((event_id * 13) % 20) * 9 as int), 64) as s
  from events join genes_v on gene = concat('g', cast(user_id % (select count(*) from supplier) as varchar(20)))) h""",
    # Contigs of two assemblers: a piece of a gene and a tail with some N.
    "contigs_v": """
select c_mktsegment as sample, case when c_custkey % 2 = 0 then 'spades' else 'megahit' end as assembler,
  concat('ctg', cast(c_custkey as varchar(20))) as ref_id,
  concat(substr(gene_seq, cast(1 + c_custkey % 60 as int), cast(60 + c_custkey % 90 as int)),
    substr(translate(repeat(md5(concat(cast(c_custkey as varchar(20)), ':t')), 8), '0123456789abcdef', 'NCGTACGTACGTACGT'),
           1, cast(16 + (c_custkey * 31) % 240 as int))) as seq
from customer join genes_v on gene = concat('g', cast(c_custkey % (select count(*) from supplier) as varchar(20)))""",
    "host_v": """
select case when s_suppkey = 0 then 'chrEBV' when s_suppkey = 1 then 'chrM' else concat('chr', cast(s_suppkey as varchar(20))) end as ref_id,
  gene_seq as seq
from supplier join genes_v on gene = concat('g', cast(s_suppkey as varchar(20)))""",
    "tax_v": """
select 1 as tax_id, 0 as parent_id, 'R' as rank, 'root' as name
union all select 2 + r_regionkey, 1, 'D',
  case r_regionkey when 0 then 'Bacteria' when 1 then 'Eukaryota' when 2 then 'Archaea' when 3 then 'Viruses' else 'Other' end
from region
union all select 100 + n_nationkey, 2 + n_regionkey, 'G', n_name from nation
union all select cast(1000 + s_suppkey as int), 100 + s_nationkey, 'S', s_name from supplier""",
    "cls_v": """
select event_type as sample, event_id as read_id,
  case when event_id % 10 = 0 then 'U' else 'C' end as status,
  cast(case when event_id % 10 = 0 then 0
       when event_id % 7 = 0 then 100 + user_id % 25
       when event_id % 11 = 0 then 2 + user_id % 4
       else 1000 + user_id % (select count(*) from supplier) end as int) as tax_id
from events""",
    "lin_v": """
select d.tax_id as d_id, cast(null as int) as g_id, cast(null as int) as s_id, d.tax_id, d.rank, d.name from tax_v d where d.rank = 'D'
union all select g.parent_id, g.tax_id, cast(null as int), g.tax_id, g.rank, g.name from tax_v g where g.rank = 'G'
union all select g.parent_id, g.tax_id, s.tax_id, s.tax_id, s.rank, s.name from tax_v s join tax_v g on s.parent_id = g.tax_id where s.rank = 'S'""",
    "rep_v": """
select c.sample,
  row_number() over (partition by c.sample order by l.d_id, coalesce(l.g_id, 0), coalesce(l.s_id, 0)) as line_no,
  c.clade_reads, coalesce(d.n, 0) as direct_reads, l.rank, l.tax_id, l.name
from (
  select sample, tax_id, cast(sum(n) as bigint) as clade_reads from (
    select a.sample, l.d_id as tax_id, a.n from (select sample, tax_id, count(*) as n from cls_v where status = 'C' group by sample, tax_id) a join lin_v l on a.tax_id = l.tax_id
    union all
    select a.sample, l.g_id, a.n from (select sample, tax_id, count(*) as n from cls_v where status = 'C' group by sample, tax_id) a join lin_v l on a.tax_id = l.tax_id where l.g_id is not null
    union all
    select a.sample, l.s_id, a.n from (select sample, tax_id, count(*) as n from cls_v where status = 'C' group by sample, tax_id) a join lin_v l on a.tax_id = l.tax_id where l.s_id is not null) u
  group by sample, tax_id) c
join lin_v l on c.tax_id = l.tax_id
left join (select sample, tax_id, count(*) as n from cls_v where status = 'C' group by sample, tax_id) d on d.sample = c.sample and d.tax_id = c.tax_id""",
    "track_v": """
select event_type as sample, 2 * count(*) as input,
  2 * count(*) as no_adapter,
  cast(2 * sum(case when event_id % 7 = 0 then 0 else 1 end) as bigint) as filtered,
  cast(2 * sum(case when event_id % 7 = 0 or event_id % 8 = 3 then 0 else 1 end) as bigint) as decontaminated,
  cast(2 * sum(case when event_id % 7 = 0 or event_id % 8 in (3, 4) then 0 else 1 end) as bigint) as qtrimmed
from events group by event_type""",
    # 21-mers of all samples but one, so that some reads stay unclassified.
    "kdb_v": """
select kmer, cast(min(tax_id) as int) as tax_id from (
  select substr(seq, cast(o as int), 21) as kmer,
    case when pair_id % 3 = 1 then 1000 + pair_id % (select count(*) from supplier) else 100 + pair_id % 25 end as tax_id
  from (select pair_id, seq, {offsets} as o from reads_v where mate = 1 and sample <> 'view') r) k
where kmer not like '%N%'
group by kmer""",
}
DIALECT["spark"]["offsets"] = "explode(sequence(1, 41, 4))"
DIALECT["duckdb"]["offsets"] = "unnest(range(1, 42, 4))"


def _needed(sql, views):
    """Names of the views a text uses, earliest first."""
    used, pending = set(), [sql]
    while pending:
        text = pending.pop()
        for name in views:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                pending.append(views[name])
    return [name for name in views if name in used]


def inline(sql, dialect, more=None):
    """Put the views a query uses in front of it as common table expressions."""
    views = {**VIEWS, **(more or {})}
    for key, text in DIALECT[dialect].items():
        views = {n: v.replace("{" + key + "}", text) for n, v in views.items()}
    ctes = [f"{name} as ({views[name]})" for name in _needed(sql, views)]
    body = sql.strip()
    recursive = "recursive" in body[:20].lower() or any("/*recursive*/" in c for c in ctes)
    if body.lower().startswith("with"):
        body = re.sub(r"^with(\s+recursive)?\s+", "", body, flags=re.I)
        ctes.append("")
        head = ", ".join(ctes)
    else:
        head = ", ".join(ctes) + (" " if ctes else "")
    if not head:
        return body
    return ("with recursive " if recursive else "with ") + head + body


class Views:
    """The views of one data folder as DataFrames: ``Views(spark, folder).reads_v``."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name):
        if name in TABLES:
            return self._table(name)
        if name not in VIEWS:
            raise AttributeError(name)
        return self.sql(f"select * from {name}")

    def _table(self, name):
        path = f"{self.folder}/{name}.parquet"
        table = self.spark.read.parquet(path)
        if name not in DEALT:
            return table
        # A test table is one row group, which is one task however many reads are made of it; tasks are as
        # many as its bytes ask for, so that none grows with the table.
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        tasks = -(-system.getContentSummary(folder).getLength() // DEALT[name])
        return table.repartition(max(tasks, self.spark.sparkContext.defaultParallelism))

    def sql(self, text):
        text = inline(text, "spark")
        for table in TABLES:
            if re.search(rf"\b{table}\b", text):
                getattr(self, table).createOrReplaceTempView(table)
        return self.spark.sql(text)
