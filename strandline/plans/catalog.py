"""Queries over the tables, each with its oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..functions import sequence as S
from ..operators import curate, histories, parsimony, relational, reports, samples, tree, variants
from ..sources import tables as T
from . import bind as B
from .scratch import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _meta(spark, d) -> DataFrame:
    return samples.combine_metadata(samples.select_metadata(B.raw_metadata(spark, d)))


def _augmented(spark, d) -> DataFrame:
    return samples.augment(materialize(_meta(spark, d), "metadata"))


# Fixed values, written out here so that the SQL does not depend on the lists of the host expression.
HOST_SQL = """CASE WHEN host IS NULL THEN 'other'
 WHEN h IN ('host', 'mammals', 'other mammals', 'feces', 'environment', 'water sample', 'other environment', 'animal', 'surface swab', 'air sample',
 'unknown', 'insect') OR contains(h, 'laboratory') THEN 'other' WHEN h = 'human' THEN 'human'
 WHEN h IN ('swine', 'pig') OR contains(h, 'sus scrofa') OR contains(h, 'sus ') THEN 'swine' WHEN h IN ('equine', 'equus caballus', 'horse', 'donkey')
 THEN 'other'
 WHEN h IN ('dairy cow', 'bovine', 'cow', 'cattle') THEN 'bovine' WHEN h IN ('canine', 'dog') OR contains(h, 'canis') OR h IN ('feline', 'cat') OR
 contains(h, 'felis') OR h IN ('seal', 'dolphin', 'whale', 'sea lion', 'walrus', 'ferret', 'mink', 'mouse', 'mus musculus', 'rodent', 'bat', 'meerkat',
 'panda', 'camel', 'primate') THEN 'other'
 WHEN regexp_matches(h,
 'avian|bird|fowl|poultry|waterfowl|duck|goose|swan|teal|mallard|pintail|wigeon|shoveler|chicken|turkey|quail|pheasant|partridge|grouse|peafowl|peacock|gull|tern|eagle|hawk|falcon|kestrel|harrier|buzzard|crow|raven|magpie|pigeon|dove|sparrow|finch|swallow|penguin|cormorant|pelican|heron|ibis|stork|crane|bustard|sandpiper|turnstone|knot|dunlin|sanderling|curlew|plover|shearwater|albatross|petrel|grebe|coot|rail|ostrich|great tit|passerine')
 OR split_part(h, ' ', 1) IN ('gallus', 'meleagris', 'coturnix', 'coturnic', 'numida', 'phasianus', 'phasanius', 'alectoris', 'pavo', 'perdix',
 'cyrtonyx', 'oreortyx', 'francolinus', 'polyplectron', 'lophura', 'anas', 'anser', 'cygnus', 'branta', 'chen', 'cairina', 'aythya', 'bucephala',
 'tadorna', 'aix', 'mareca', 'melanitta', 'somateria', 'clangula', 'oxyura', 'mergus', 'lophodytes', 'dendrocygna', 'netta', 'larus', 'sterna',
 'chroicocephalus', 'leucophaeus', 'gelochelidon', 'chlidonias', 'hydroprogne', 'rissa', 'xema', 'larosterna', 'rynchops', 'calidris', 'arenaria',
 'numenius', 'tringa', 'scolopax', 'catoptrophorus', 'himantopus', 'gallinago', 'falco', 'buteo', 'accipiter', 'haliaeetus', 'halietus', 'circus',
 'parabuteo', 'nisaetus', 'morphnus', 'necrosyrtes', 'gyps', 'corvus', 'pica', 'columba', 'streptopelia', 'pygoscelis', 'spheniscus', 'podiceps',
 'tachybaptus', 'gallinula', 'anthropoides', 'passer', 'hirundo', 'zosterops', 'copsychus', 'garrulax', 'gracula', 'stercorarius', 'falsco',
 'anseriformes') THEN 'avian' ELSE '__unrecognized__' END"""
GEO_SQL = "CASE trim(split_part(location, '/', 1), ' ' || chr(9)) WHEN 'North America' THEN 'north_america' WHEN 'Europe' THEN 'europe' WHEN 'Asia' THEN 'asia' ELSE 'other' END"
#: meta with groups; the date split is the upper median of all dates.
AUGMENTED = (
    B.DATED
    + f""", med AS (SELECT list_sort(list(d) FILTER (WHERE d IS NOT NULL))[count(d) // 2 + 1] AS m FROM dated),
aug AS (SELECT ord, isolate_id, subtype, collection_date, d, {HOST_SQL} AS host_group, {GEO_SQL} AS geographic_group,
  CASE WHEN d IS NULL THEN 'unknown' WHEN d <= (SELECT m FROM med) THEN 'early' ELSE 'late' END AS temporal_group FROM (SELECT *, lower(host) AS h FROM dated))"""
)


# --- metadata ----------------------------------------------------------------------------------------------------


@query(f"WITH {AUGMENTED} SELECT host_group, geographic_group, temporal_group, count(*) AS n FROM aug GROUP BY ALL")
def entry_metadata_groups(spark, d):
    """Isolates by host, continent and half of the collection period."""
    return _augmented(spark, d).groupBy("host_group", "geographic_group", "temporal_group").agg(F.count("*").alias("n"))


@query(f"WITH {B.METADATA} SELECT isolate_id, isolate_name, subtype, clade, passage_history, location, host, collection_date FROM meta")
def metadata_first_wins(spark, d):
    """Required columns, first row of each isolate."""
    return _meta(spark, d).drop("ord")


@query(f"WITH {B.RAW_METADATA} SELECT count(*) AS n_rows, count(DISTINCT isolate_id) AS n_distinct, count(*) - count(DISTINCT isolate_id) AS n_duplicates FROM raw_meta")
def metadata_duplicates(spark, d):
    """U4."""
    return relational.duplicate_count(samples.select_metadata(B.raw_metadata(spark, d)), ["isolate_id"])


@query(f"WITH {B.RAW_METADATA} SELECT location, count(*) AS n FROM raw_meta WHERE location IS NOT NULL GROUP BY location")
def location_counts(spark, d):
    """A1: counts by value without nulls."""
    return relational.value_counts(samples.select_metadata(B.raw_metadata(spark, d)), "location")


@query(f"WITH {B.METADATA} SELECT isolate_id, {GEO_SQL} AS geographic_group FROM meta")
def geographic_groups(spark, d):
    """C15."""
    return _meta(spark, d).select("isolate_id", M.geographic_group("location").alias("geographic_group"))


@query(f"WITH {B.METADATA} SELECT isolate_id, {HOST_SQL} AS host_group FROM (SELECT *, lower(host) AS h FROM meta)")
def host_groups(spark, d):
    """The host annotation table."""
    return _meta(spark, d).select("isolate_id", M.host_group("host", strict=False).alias("host_group"))


@query(f"WITH {B.DATED} SELECT isolate_id, strftime(d, '%Y-%m-%d') AS d, coalesce(strftime(d, '%Y-%m-%d'), 'N/A') AS shown FROM dated")
def parsed_dates(spark, d):
    """E1, E2, E4, F15."""
    return _meta(spark, d).select("isolate_id", F.date_format(M.parse_date("collection_date"), "yyyy-MM-dd").alias("d"), M.iso_or_na(M.parse_date("collection_date")).alias("shown"))


@query(f"WITH {B.DATED}, g AS (SELECT clade, list_sort(list(d) FILTER (WHERE d IS NOT NULL)) AS l FROM dated GROUP BY clade) SELECT clade, strftime(l[len(l) // 2 + 1], '%Y-%m-%d') AS median FROM g")
def upper_median_by_group(spark, d):
    """A6, G1."""
    rows = _meta(spark, d).select("clade", M.parse_date("collection_date").alias("d"))
    return rows.groupBy("clade").agg(relational.upper_median("d").alias("m")).select("clade", F.date_format("m", "yyyy-MM-dd").alias("median"))


@query(
    f"""WITH {AUGMENTED}, s AS (SELECT host_group, CASE WHEN starts_with(subtype, 'A / ') THEN substr(subtype, 5) ELSE subtype END AS subtype FROM aug),
n AS (SELECT host_group, subtype, count(*) AS c FROM s GROUP BY ALL), t AS (SELECT *, CAST(sum(c) OVER (PARTITION BY subtype) AS BIGINT) AS tot FROM n)
SELECT host, subtype, "count", total, fraction FROM (SELECT host_group AS host, subtype, c AS "count", tot AS total, c / tot AS fraction,
  row_number() OVER (PARTITION BY host_group ORDER BY c DESC, subtype) AS rn FROM t WHERE host_group IN ('human', 'avian', 'swine', 'bovine')) WHERE rn <= 10"""
)
def host_subtype_top10(spark, d):
    """A top-k report."""
    return reports.host_subtypes(_augmented(spark, d), ["human", "avian", "swine", "bovine"])


@query(f"WITH {B.METADATA} SELECT CASE WHEN starts_with(subtype, 'A / ') THEN substr(subtype, 5) ELSE subtype END AS subtype, count(*) AS n FROM meta GROUP BY ALL ORDER BY n DESC, subtype LIMIT 10")
def subtype_top10(spark, d):
    """The ten most frequent subtypes, a top-k report."""
    return reports.top_values(_meta(spark, d).select(M.strip_type_prefix("subtype").alias("subtype")), "subtype", 10)


@query(f"WITH {AUGMENTED} SELECT host_group, format('{{:,}}', count(*)) AS n FROM aug GROUP BY host_group")
def formatted_host_counts(spark, d):
    """Counts with thousands separators."""
    return reports.formatted(relational.value_counts(_augmented(spark, d), "host_group"), ["n"])


# --- sequence records --------------------------------------------------------------------------------------------


@query(
    f"""WITH {B.RECORDS} SELECT segment, grp, id, seq FROM (SELECT *, row_number() OVER (PARTITION BY segment, grp, id ORDER BY ord) AS rn FROM grouped
WHERE NOT malformed AND grp IS NOT NULL) WHERE rn = 1"""
)
def parsed_records(spark, d):
    """D2, F3, F4, C3, U2."""
    return samples.parse_records(B.records(spark, d))[0].drop("ord")


@query(
    f"""WITH {B.RECORDS} SELECT segment, grp, count(DISTINCT id) AS n FROM grouped
WHERE NOT malformed AND grp IS NOT NULL AND segment IN ('HA', 'NA', 'PB2') GROUP BY ALL"""
)
def records_per_group(spark, d):
    """F2, A2: a segment whitelist."""
    kept = samples.parse_records(B.records(spark, d), ["HA", "NA", "PB2"])[0]
    return kept.groupBy("segment", "grp").agg(F.count("*").alias("n"))


@query(f"WITH {B.RECORDS} SELECT CASE WHEN malformed THEN 'malformed' ELSE 'subtype' END AS reason, count(*) AS n FROM grouped WHERE malformed OR grp IS NULL GROUP BY ALL")
def rejected_records(spark, d):
    """rejects with their reason."""
    return samples.parse_records(B.records(spark, d))[1].groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT page_id, translate(url, '[]():;,''.', '') AS clean, contains(translate(url, '[]():;,''.', ''), ' ') AS has_blank FROM pages")
def sanitized_ids(spark, d):
    """C1, F17."""
    clean = S.sanitize_id("url")
    return B.table(spark, d, "pages").select("page_id", clean.alias("clean"), clean.contains(" ").alias("has_blank"))


@query(
    """SELECT event_id, CASE WHEN contains(a, 'user=') THEN split_part(split_part(a, 'user=', 2), ';', 1) END AS u, CASE WHEN contains(a, 'none=') THEN '' END AS missing
FROM (SELECT event_id, 'ID=' || event_id || ';user=' || user_id || ';type=' || event_type AS a FROM events)"""
)
def attribute_values(spark, d):
    """C2, C22."""
    e = B.table(spark, d, "events")
    a = F.concat(F.lit("ID="), F.col("event_id").cast("string"), F.lit(";user="), F.col("user_id").cast("string"), F.lit(";type="), F.col("event_type"))
    return e.select("event_id", S.attribute_value(a, "user").alias("u"), S.attribute_value(a, "none").alias("missing"))


# --- curation ----------------------------------------------------------------------------------------------------

LIMITS = curate.Thresholds(max_frac_gaps=0.03, max_frac_ambig=0.15)
JUDGED = (
    B.ALIGNMENT
    + """, measured AS (SELECT *, length(seq) AS len, length(seq) - length(replace(seq, '-', '')) AS gaps, length(regexp_replace(seq, '[ACGT-]', '', 'g')) AS ambig,
  regexp_replace(seq, '[^ACGT-]', 'N', 'g') AS masked FROM msa),
judged AS (SELECT *, CASE WHEN ord > min(ord) OVER (PARTITION BY grp, masked) THEN 'failed_duplicate'
  WHEN left(seq, 3) = '---' OR right(seq, 3) = '---' THEN 'failed_terminal_gaps' WHEN gaps / len > 0.03 THEN 'failed_gap_fraction'
  WHEN ambig / len > 0.15 THEN 'failed_ambig_fraction' WHEN len = 0 THEN 'empty' END AS reason FROM measured)"""
)


def _judged(spark, d) -> DataFrame:
    return curate.quality_reason(curate.measure(B.alignment(spark, d), t=LIMITS), t=LIMITS)


@query(f"WITH {JUDGED} SELECT id, CAST(len AS INT) AS length, CASE WHEN len > 0 THEN gaps / len END AS frac_gaps, CASE WHEN len > 0 THEN ambig / len END AS frac_ambiguous FROM judged")
def sequence_metrics(spark, d):
    """C5, D10."""
    return curate.measure(B.alignment(spark, d)).select("id", "length", "frac_gaps", "frac_ambiguous")


@query(f"WITH {JUDGED} SELECT id, grp, reason FROM judged")
def quality_cascade(spark, d):
    """One reason for each rejected sequence."""
    return _judged(spark, d).select("id", "grp", "reason")


@query(
    f"""WITH {JUDGED} SELECT grp, count(*) AS total_processed, count(*) FILTER (WHERE reason = 'failed_duplicate') AS failed_duplicate, count(*) FILTER (WHERE reason = 'failed_terminal_gaps') AS failed_terminal_gaps,
count(*) FILTER (WHERE reason = 'failed_gap_fraction') AS failed_gap_fraction, count(*) FILTER (WHERE reason = 'failed_ambig_fraction') AS failed_ambig_fraction,
count(*) FILTER (WHERE reason IS NULL) AS passed_quality_filters, 100.0 * count(*) FILTER (WHERE reason IS NULL) / count(*) AS retention_pct FROM judged GROUP BY grp"""
)
def quality_statistics(spark, d):
    """A3, A4, D11."""
    return curate.quality_stats(_judged(spark, d))


@query(f"WITH {B.ALIGNMENT} SELECT id, replace(regexp_replace(seq, '[^ACGT-]', 'N', 'g'), '-', '') AS degapped FROM msa")
def degapped(spark, d):
    """C6, C8."""
    return B.alignment(spark, d).select("id", S.degap(S.mask("seq")).alias("degapped"))


@query(f"WITH {B.ALIGNMENT} SELECT id, substr(seq, 11, 90) AS region, substr(seq, 5, 1) AS one FROM msa")
def sliced(spark, d):
    """C4, C11."""
    return B.alignment(spark, d).select("id", S.slice_seq("seq", 11, 100).alias("region"), S.slice_seq("seq", 5, 5).alias("one"))


@query(f"WITH {B.ALIGNMENT} SELECT DISTINCT unnest(string_split(regexp_replace(seq, '[ACGT-]', '', 'g'), '')) AS ch FROM msa WHERE length(regexp_replace(seq, '[ACGT-]', '', 'g')) > 0")
def ambiguous_characters(spark, d):
    """The set of characters beside A, C, G, T and gaps."""
    rest = F.regexp_replace("seq", "[ACGT-]", "")
    return B.alignment(spark, d).select(F.explode(F.array_distinct(F.split(rest, ""))).alias("ch")).where("ch != ''").distinct()


def _insertions(spark, d) -> DataFrame:
    li = B.table(spark, d, "lineitem")
    item = F.concat((F.col("l_linenumber") * 3).cast("string"), F.lit(":"), F.substr(F.lit("ACGTACGTA"), F.lit(1), F.col("l_linenumber")))
    return li.groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", item.alias("x")))), lambda s: s["x"]), ", ").alias("text"))


_INS_SQL = "items AS (SELECT l_orderkey AS k, l_linenumber * 3 AS pos, substr('ACGTACGTA', 1, l_linenumber) AS nucs FROM lineitem)"


@query(f"WITH {_INS_SQL} SELECT k, string_agg(pos || ':' || nucs, ',' ORDER BY pos DESC, nucs DESC) AS ins, count(*) AS n FROM items GROUP BY k")
def parsed_insertions(spark, d):
    """C10, O3, D9."""
    ins = _insertions(spark, d).select(F.col("l_orderkey").alias("k"), S.parse_insertions("text").alias("i"))
    return ins.select("k", F.array_join(F.transform("i", lambda x: F.concat_ws(":", x["pos"].cast("string"), x["nucs"])), ",").alias("ins"), F.size("i").cast("long").alias("n"))


@query(
    f"""WITH {_INS_SQL}, win AS (SELECT k, pos - 5 AS pos, nucs FROM items WHERE pos >= 6 AND pos < 15)
SELECT k, string_agg(pos || ':' || nucs, ',' ORDER BY pos DESC, nucs DESC) AS ins FROM win GROUP BY k"""
)
def insertions_in_window(spark, d):
    """Start included, end excluded, shifted to the fragment."""
    ins = _insertions(spark, d).select(F.col("l_orderkey").alias("k"), S.insertions_in_cds(S.parse_insertions("text"), F.lit(6), F.lit(15), 0).alias("i")).where(F.size("i") > 0)
    return ins.select("k", F.array_join(F.transform("i", lambda x: F.concat_ws(":", x["pos"].cast("string"), x["nucs"])), ",").alias("ins"))


@query(
    f"""WITH {_INS_SQL}, l AS (SELECT k, list({{'pos': pos, 'nucs': nucs}} ORDER BY pos DESC, nucs DESC) AS i FROM items GROUP BY k)
SELECT k, list_reduce(list_prepend({{'pos': 0, 'nucs': 'ACGTACGTACGTACGT'}}, i), lambda a, x: {{'pos': 0, 'nucs': substr(a.nucs, 1, x.pos) || x.nucs || substr(a.nucs, x.pos + 1)}}).nucs AS seq FROM l"""
)
def applied_insertions(spark, d):
    """From the highest position down."""
    return _insertions(spark, d).select(F.col("l_orderkey").alias("k"), S.insert(F.lit("ACGTACGTACGTACGT"), S.parse_insertions("text")).alias("seq"))


CDS_SQL = """SELECT k, CASE WHEN length(s) % 3 <> 0 THEN 'wrong_length' WHEN length(s) < 6 THEN 'too_short' WHEN NOT starts_with(upper(s), 'ATG') THEN 'missing_start_codon'
WHEN right(upper(s), 3) NOT IN ('TAA', 'TAG', 'TGA') THEN 'missing_stop_codon' END AS reason FROM cds"""


@query("WITH cds AS (SELECT o_orderkey AS k, left('ATGCATGACGTA', CAST(o_orderkey % 13 AS INT)) || CASE o_orderkey % 4 WHEN 0 THEN 'TAA' WHEN 1 THEN 'tga' WHEN 2 THEN 'TAG' ELSE '' END AS s FROM orders) " + CDS_SQL)
def cds_validity(spark, d):
    """The first failure wins."""
    k = F.col("o_orderkey")
    tail = F.when(k % 4 == 0, "TAA").when(k % 4 == 1, "tga").when(k % 4 == 2, "TAG").otherwise("")
    seq = F.concat(F.left(F.lit("ATGCATGACGTA"), (k % 13).cast("int")), tail)
    return B.table(spark, d, "orders").select(k.alias("k"), S.cds_failure(seq).alias("reason"))


def _gene_rows(spark, d) -> DataFrame:
    """Every sequence of the alignment against the small gene model; raw sequences are the degapped ones of the even rows and broken ones of the others."""
    msa = _judged(spark, d)
    feats = T.parse_gff(B.gene_features(spark)).withColumn("grp", F.lit(0))
    genes = curate.gene_model(feats).drop("grp")
    groups = msa.select("grp").distinct()
    genes = groups.withColumn("_g", F.lit(0)).join(genes.withColumn("_g", F.lit(0)), "_g").drop("_g")
    raw = msa.select("grp", "id", F.when(F.col("ord") % 2 == 0, S.degap("masked")).otherwise(F.lit("ACGT")).alias("raw"))
    none = msa.select("grp", "id", F.array().cast(S.INSERTIONS).alias("ins"))
    return curate.keep_valid(curate.gene_results(msa, genes, raw, none, 3))


_GENES_SQL = (
    JUDGED
    + """, g AS (SELECT * FROM (VALUES (1, 'M1', 1, 30, 0, 0), (2, 'M2', 1, 21, 61, 30)) t(gene_idx, gene_name, s1, n1, s2, n2)),
parts AS (SELECT j.grp, j.id, j.ord, g.gene_idx, g.gene_name, replace(substr(masked, s1, n1), '-', '') AS p1, CASE WHEN s2 > 0 THEN replace(substr(masked, s2, n2), '-', '') END AS p2,
  CASE WHEN j.ord % 2 = 0 THEN replace(masked, '-', '') ELSE 'ACGT' END AS raw FROM judged j, g WHERE NOT j.is_ref),
res AS (SELECT *, CAST(NOT contains(raw, p1) AS INT) + coalesce(CAST(NOT contains(raw, p2) AS INT), 0) AS bad, p1 || coalesce(p2, '') AS s FROM parts),
why AS (SELECT *, CASE WHEN bad > 0 THEN 'fragment_validation' WHEN length(s) % 3 <> 0 THEN 'wrong_length' WHEN length(s) < 6 THEN 'too_short' WHEN NOT starts_with(s, 'ATG') THEN 'missing_start_codon'
  WHEN right(s, 3) NOT IN ('TAA', 'TAG', 'TGA') THEN 'missing_stop_codon' END AS reason FROM res),
kept AS (SELECT *, min(CASE WHEN reason IS NOT NULL THEN gene_idx END) OVER (PARTITION BY grp, id) AS f FROM why)"""
)


@query(f"WITH {_GENES_SQL} SELECT grp, id, gene_name, s AS cds_seq, reason, f IS NULL AS row_ok FROM kept")
def gene_sequences(spark, d):
    """Spliced and plain genes of every sequence."""
    return _gene_rows(spark, d).select("grp", "id", "gene_name", "cds_seq", "reason", "row_ok")


@query(
    f"""WITH {_GENES_SQL}, c AS (SELECT *, f IS NULL OR gene_idx <= f AS counted FROM kept),
t AS (SELECT grp, gene_name, CAST(coalesce(sum(bad) FILTER (WHERE counted), 0) AS BIGINT) AS fragment_validation, count(*) FILTER (WHERE counted AND reason = 'wrong_length') AS wrong_length,
  count(*) FILTER (WHERE counted AND reason = 'too_short') AS too_short, count(*) FILTER (WHERE counted AND reason = 'missing_start_codon') AS missing_start_codon,
  count(*) FILTER (WHERE counted AND reason = 'missing_stop_codon') AS missing_stop_codon FROM c GROUP BY ALL)
SELECT *, fragment_validation + wrong_length + too_short + missing_start_codon + missing_stop_codon AS total_failures FROM t"""
)
def gene_failures(spark, d):
    """Failures per gene, not counting genes behind the first failing one."""
    return curate.cds_stats(_gene_rows(spark, d))


def _document_insertions(spark, d) -> DataFrame:
    """(grp, id, ins) from report texts; every fifth document has none."""
    k = F.col("doc_id")
    one = F.concat((k % 30 + 1).cast("string"), F.lit(":"), F.substr(F.lit("ACGTAC"), F.lit(1), (k % 3 + 1).cast("int")))
    two = F.concat((k % 17 + 60).cast("string"), F.lit(":GG"))
    rows = B.table(spark, d, "documents").where("text is not null and doc_id % 5 <> 0")
    return rows.select(F.col("lang").alias("grp"), F.concat(F.lit("EPI_ISL_"), k.cast("string")).alias("id"), S.parse_insertions(F.concat_ws(", ", one, two)).alias("ins"))


def _genes_of(spark, groups: DataFrame) -> DataFrame:
    genes = curate.gene_model(T.parse_gff(B.gene_features(spark)).withColumn("grp", F.lit(0))).drop("grp")
    return groups.withColumn("_g", F.lit(0)).join(genes.withColumn("_g", F.lit(0)), "_g").drop("_g")


def _put(seq: str, items: str) -> str:
    """SQL: seq with a descending list of (pos, nucs) put behind their positions."""
    return f"list_reduce(list_prepend({{'pos': 0, 'nucs': {seq}}}, {items}), lambda a, x: {{'pos': 0, 'nucs': substr(a.nucs, 1, x.pos) || x.nucs || substr(a.nucs, x.pos + 1)}}).nucs"


def _cut(start: str, n: str) -> str:
    """SQL: a coding part with the insertions that it holds, degapped, in both coordinate modes."""
    inside = f"list_transform(list_filter(ins, lambda x: x.pos >= {start} + 3 AND x.pos < {start} + {n} + 2), lambda x: {{'pos': x.pos - CASE WHEN legacy THEN 3 ELSE {start} + 2 END, 'nucs': x.nucs}})"
    return f"replace({_put(f'substr(masked, {start}, {n})', inside)}, '-', '')"


_INSERTED_SQL = (
    JUDGED
    + f""", g AS (SELECT * FROM (VALUES (1, 'M1', 1, 30, 0, 0), (2, 'M2', 1, 21, 61, 30)) t(gene_idx, gene_name, s1, n1, s2, n2)),
li AS (SELECT *, CASE WHEN ord % 5 <> 0 THEN [{{'pos': CAST(ord % 17 + 60 AS INT), 'nucs': 'GG'}}, {{'pos': CAST(ord % 30 + 1 AS INT), 'nucs': substr('ACGTAC', 1, CAST(ord % 3 + 1 AS INT))}}] ELSE [] END AS ins FROM judged WHERE NOT is_ref),
lr AS (SELECT li.*, replace({_put("masked", "list_transform(list_filter(ins, lambda x: x.pos >= 3), lambda x: {'pos': x.pos - 3, 'nucs': x.nucs})")}, '-', '') AS raw FROM li),
pt AS (SELECT lr.*, g.*, legacy, {_cut("s1", "n1")} AS p1, CASE WHEN s2 > 0 THEN {_cut("s2", "n2")} END AS p2 FROM lr, g, (VALUES (false), (true)) m(legacy)),
rs AS (SELECT *, CAST(NOT contains(raw, p1) AS INT) + coalesce(CAST(NOT contains(raw, p2) AS INT), 0) AS bad, p1 || coalesce(p2, '') AS s FROM pt)"""
)


@query(
    f"""WITH {_INSERTED_SQL} SELECT grp, id, gene_name, legacy, s AS cds_seq, bad AS n_bad_fragments,
CASE WHEN bad > 0 THEN 'fragment_validation' WHEN length(s) % 3 <> 0 THEN 'wrong_length' WHEN length(s) < 6 THEN 'too_short' WHEN NOT starts_with(s, 'ATG') THEN 'missing_start_codon'
  WHEN right(s, 3) NOT IN ('TAA', 'TAG', 'TGA') THEN 'missing_stop_codon' END AS reason FROM rs"""
)
def gene_sequences_with_insertions(spark, d):
    """Insertions put back in both coordinate modes; the raw sequence has them where they were."""
    msa = materialize(_judged(spark, d), "judged")
    ins = _document_insertions(spark, d)
    where = F.transform(F.filter("ins", lambda x: x["pos"] >= 3), lambda x: F.struct((x["pos"] - 3).alias("pos"), x["nucs"].alias("nucs")))
    raw = msa.join(ins, ["grp", "id"], "left").select("grp", "id", S.degap(S.insert("masked", F.coalesce(where, F.array().cast(S.INSERTIONS)))).alias("raw"))
    genes = _genes_of(spark, msa.select("grp").distinct())
    out = [curate.gene_results(msa, genes, raw, ins, 3, legacy=m).withColumn("legacy", F.lit(m)) for m in (False, True)]
    return out[0].unionByName(out[1]).select("grp", "id", "gene_name", "legacy", "cds_seq", "n_bad_fragments", "reason")


@query(
    """WITH i AS (SELECT lang AS grp, 'EPI_ISL_' || doc_id AS id, doc_id % 30 + 1 AS pos, substr('ACGTAC', 1, CAST(doc_id % 3 + 1 AS INT)) AS nucs FROM documents WHERE text IS NOT NULL AND doc_id % 5 <> 0
  UNION ALL SELECT lang, 'EPI_ISL_' || doc_id, doc_id % 17 + 60, 'GG' FROM documents WHERE text IS NOT NULL AND doc_id % 5 <> 0),
p AS (SELECT * FROM (VALUES (1, 0, 4, 33), (2, 0, 4, 24), (2, 1, 64, 93)) t(gene_idx, part, s, e))
SELECT grp, id, gene_idx, part, nucs, CAST(pos - s + 1 AS INT) AS pos, CAST(pos - 3 AS INT) AS legacy_pos FROM i JOIN p ON pos >= s AND pos < e"""
)
def placed_insertions(spark, d):
    """Exploded insertions joined with the coding parts that hold them, an interval join by bins."""
    ins = _document_insertions(spark, d)
    return curate.placed_insertions(ins, _genes_of(spark, ins.select("grp").distinct()), 3)


@query(f"WITH {B.ALIGNMENT} SELECT grp, id, CASE WHEN NOT is_ref THEN contains(CASE WHEN ord % 2 = 0 THEN upper(seq) ELSE 'ACGT' END, upper(replace(seq, '-', ''))) END AS found FROM msa")
def raw_audit(spark, d):
    """sequences looked up in their raw ones; only references may lack one."""
    msa = B.alignment(spark, d)
    raw = msa.where("not is_ref").select("grp", "id", F.when(F.col("ord") % 2 == 0, F.col("seq")).otherwise("ACGT").alias("raw"))
    return curate.validate_against_raw(msa, raw).select("grp", "id", "found")


# --- files -------------------------------------------------------------------------------------------------------


@query(ORACLE["parsed_records"])
def grouped_fasta(spark, d):
    """Records written as xz-packed FASTA, a folder per segment and group, and read back."""
    path = scratch_path(spark, "grouped-fasta")
    T.write_fasta(samples.parse_records(B.records(spark, d))[0], path, "xz", by=["segment", "grp"])
    back = T.read_fasta(spark, path)
    return back.select(T.folder_value("segment").alias("segment"), T.folder_value("grp").alias("grp"), "id", "seq")


@query(f"WITH {B.ALIGNMENT} SELECT id, md5(regexp_replace(seq, '[^ACGT-]', 'N', 'g')) AS digest, CAST(row_number() OVER (ORDER BY grp, ord) AS INT) AS place FROM msa")
def split_fasta(spark, d):
    """The alignment as one ordered FASTA file, read back in splits of 256 KB; places follow the offsets."""
    path = scratch_path(spark, "split-fasta")
    rows = B.alignment(spark, d).select("grp", F.col("ord").alias("row"), "id", S.mask("seq").alias("seq"))
    T.write_fasta(T.with_row_order(rows, "grp", "row"), path, single=True)
    back = T.read_fasta(spark, path, split_bytes=str(256 << 10)).select("ord", "id", F.md5(F.col("seq").cast("binary")).alias("digest"))
    return relational.numbered(back, [], ["ord"], "place").drop("ord")


_WALK = B.TREE + """, w AS (SELECT c.node, concat_ws(' ', 'root:', r.node || ':' || r.mut, n.node || ':' || n.mut, c.node || ':' || c.mut) AS path, r.node AS rn, n.node AS nn
  FROM edges c JOIN edges n ON n.node = c.parent JOIN edges r ON r.node = n.parent WHERE c.depth = 3)"""


def _report_lines(spark, d) -> DataFrame:
    """GFF lines, one per line item: genes, coding parts and others, with a name, an id only, or neither."""
    li = B.table(spark, d, "lineitem")
    k, start = F.col("l_orderkey") * 10 + F.col("l_linenumber"), F.col("l_partkey") % 900 + 20
    kind = F.when(F.col("l_linenumber") % 3 == 0, "gene").when(F.col("l_linenumber") % 3 == 1, "CDS").otherwise("exon")
    attrs = F.when(k % 4 == 0, F.concat(F.lit("ID=f"), k.cast("string"), F.lit(";Name=N"), (k % 7).cast("string"))).when(k % 4 == 1, F.concat(F.lit("ID=f"), k.cast("string"))).otherwise("note=x")
    line = F.concat_ws("\t", F.lit("seg"), F.lit("x"), kind, start.cast("string"), (start + F.col("l_suppkey") % 300).cast("string"), F.lit("."), F.lit("+"), F.lit("0"), attrs)
    return li.select(k.cast("long").alias("ord"), F.when(k % 11 == 0, F.lit("not a line")).otherwise(line).alias("line"))


_REPORT_SQL = """fl AS (SELECT l_orderkey * 10 + l_linenumber AS k, CASE l_linenumber % 3 WHEN 0 THEN 'gene' WHEN 1 THEN 'CDS' END AS kind, l_partkey % 900 + 20 AS s, l_partkey % 900 + 20 + l_suppkey % 300 AS e FROM lineitem),
ft AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'ID=f' || k || ';Name=N' || k % 7 WHEN k % 4 = 1 THEN 'ID=f' || k ELSE 'note=x' END AS a, CASE WHEN k % 4 < 2 THEN 'f' || k ELSE '' END AS id,
  CASE k % 4 WHEN 0 THEN 'N' || k % 7 WHEN 1 THEN 'f' || k ELSE kind || '_feature' END AS name FROM fl WHERE kind IS NOT NULL AND k % 11 <> 0), fm AS (SELECT min(s) AS m, max(e) AS x FROM ft)"""


@query(f"WITH {_REPORT_SQL} SELECT k AS ord, kind AS type, CAST(s AS INT) AS start, CAST(e AS INT) AS 'end', id, name FROM ft")
def gff_features(spark, d):
    """Gene and coding lines; the name falls back to the id, then to the type."""
    f = T.parse_gff(_report_lines(spark, d))
    return f.select("ord", "type", "start", "end", F.coalesce("id", F.lit("")).alias("id"), "name")


@query(
    f"""WITH {_REPORT_SQL} SELECT 'gff' AS form, k + 2 AS ord, concat_ws(chr(9), 'Reference', 'Curated', kind, s - m + 1, e - m + 1, '.', '+', '0', a) AS line FROM ft, fm
UNION ALL SELECT 'gff', -2, '##gff-version 3' UNION ALL SELECT 'gff', -1, '##sequence-region Reference 1 ' || (x - m + 1) FROM fm
UNION ALL SELECT 'gtf', k, concat_ws(chr(9), 'Reference', 'Curated', kind, s - m + 1, e - m + 1, '.', '+', '0',
  'gene_id "' || g || '"; transcript_id "' || g || '_transcript"; gene_name "' || name || '";') FROM (SELECT *, CASE WHEN id <> '' THEN id ELSE name END AS g FROM ft), fm"""
)
def shifted_annotations(spark, d):
    """K4, K5, C14: GFF3 and GTF text whose coordinates begin with the first feature."""
    f = T.parse_gff(_report_lines(spark, d))
    first = f.agg(F.min("start")).first()[0] or 1
    return curate.shifted_gff(f, first).select(F.lit("gff").alias("form"), "ord", "line").unionByName(curate.shifted_gtf(f, first).select(F.lit("gtf").alias("form"), "ord", "line"))


@query(f"WITH {B.RAW_METADATA} SELECT isolate_id, isolate_name, subtype, clade, nullif(location, '') AS location, host, collection_date FROM raw_meta")
def metadata_files(spark, d):
    """Raw metadata written as CSV and read back, texts for missing values as null."""
    path = scratch_path(spark, "metadata-csv")
    rows = samples.select_metadata(B.raw_metadata(spark, d))
    T.write_csv(rows.select("isolate_id", "isolate_name", "subtype", "clade", "location", F.coalesce("host", F.lit("NA")).alias("host"), F.regexp_replace("collection_date", "^$", "N/A").alias("collection_date")), path)
    return T.read_metadata(spark, path).drop("ord")


@query("""WITH i AS (SELECT 's' || l_orderkey AS id, l_linenumber * 3 AS pos, substr('ACGTACGTA', 1, l_linenumber) AS nucs FROM lineitem WHERE l_orderkey % 4 <> 0)
SELECT id, string_agg(pos || ':' || nucs, ',' ORDER BY pos DESC, nucs DESC) AS ins FROM i GROUP BY id""")
def insertion_reports(spark, d):
    """Alignment reports written as tab-separated text and read back; rows without insertions don't count."""
    path = scratch_path(spark, "insertion-report")
    text = F.when(F.col("l_orderkey") % 4 != 0, F.col("text"))
    _insertions(spark, d).select(F.concat(F.lit("s."), F.col("l_orderkey").cast("string")).alias("seqName"), text.alias("insertions")).write.option("header", True).option("sep", "\t").csv(path)
    return T.read_insertions(spark, path).select("id", F.array_join(F.transform("ins", lambda x: F.concat_ws(":", x["pos"].cast("string"), x["nucs"])), ",").alias("ins"))


@query(f"WITH {_WALK} SELECT node AS \"sample\", path FROM w")
def path_files(spark, d):
    """Mutation paths written as text, with lines of another form among them, and read back."""
    path = scratch_path(spark, "paths")
    rows = mutation_paths(spark, d)
    lines = rows.select(F.concat_ws("\t", "node", "path").alias("line")).unionByName(rows.select(F.concat(F.lit("# "), F.col("node")).alias("line")))
    T.write_lines(lines, path, order=None)
    return T.read_paths(spark, path).select("sample", "path")


@query(f"WITH {B.LOGS} SELECT split_part(label, '_', 1) AS segment, split_part(label, '_', 2) AS grp, count(*) AS n FROM labelled GROUP BY label")
def log_files(spark, d):
    """Log texts written under segment and group, read back by a glob, with the keys from their paths."""
    path = scratch_path(spark, "logs")
    rows = B.logs(spark, d).select(F.split_part("label", F.lit("_"), F.lit(1)).alias("segment"), F.split_part("label", F.lit("_"), F.lit(2)).alias("grp"), F.translate("text", "\n", " ").alias("value"))
    rows.write.partitionBy("segment", "grp").text(path)
    back = T.read_logs(spark, f"{path}/*/*/*.txt")
    key = lambda c: F.regexp_replace(c, "^[^=]*=", "").alias(c)
    return back.select(key("segment"), key("grp"), F.explode(F.split("text", "\n")).alias("line")).where("trim(line) <> ''").groupBy("segment", "grp").agg(F.count("*").alias("n"))


@query(f"WITH {B.ALIGNMENT}, r AS (SELECT grp, replace(seq, '-', 'A') AS ref FROM msa WHERE is_ref) SELECT id, md5(array_to_string(list_transform(list_zip(string_split(seq, ''), string_split(ref, '')), lambda z: CASE WHEN z[1] = '-' THEN coalesce(z[2], '') ELSE coalesce(z[1], '') END), '')) AS digest FROM msa JOIN r USING (grp) WHERE length(ref) <= length(seq)")
def gap_filled(spark, d):
    """Gaps of whole sequences filled from their group's reference."""
    msa = B.alignment(spark, d)
    ref = msa.where("is_ref").select("grp", F.replace("seq", F.lit("-"), F.lit("A")).alias("_ref"))
    rows = variants.with_reference(msa, ref, ["grp"], "_ref").where("length(_ref) <= length(seq)")
    return rows.select("id", F.md5(S.fill_gaps("seq", "_ref").cast("binary")).alias("digest"))


@query(f"WITH {B.TREE} SELECT node, CASE WHEN mut = '' THEN repeat('A', 60) ELSE substr(repeat('A', 60), 1, p - 1) || right(mut, 1) || substr(repeat('A', 60), p + 1) END AS seq, CASE WHEN mut = '' OR left(mut, 1) = 'A' THEN 0 ELSE 1 END AS n_mismatched FROM (SELECT *, CAST(nullif(substr(mut, 2, length(mut) - 2), '') AS INT) AS p FROM edges WHERE depth = 3)")
def leaf_haplotypes(spark, d):
    """leaves' sequences from their differences, and mutations that don't name the reference's base."""
    leaves = B.tree(spark, d).where(F.col("node").startswith("c")).select("node", "muts")
    return variants.leaf_haplotypes(leaves, "A" * 60).drop("muts")


# --- alignments, variants, identity ------------------------------------------------------------------------------


@query(
    f"""WITH {AUGMENTED}, {B.ALIGNMENT}, ids AS (SELECT DISTINCT grp, id FROM msa WHERE NOT is_ref), r AS (SELECT i.*, a.host_group AS v FROM ids i LEFT JOIN aug a ON a.isolate_id = i.id),
cats AS (SELECT unnest(['human', 'avian', 'swine', 'bovine', 'other']) AS value), tot AS (SELECT grp, count(DISTINCT id) AS total FROM r GROUP BY grp)
SELECT t.grp, c.value, count(r.v) AS "count", any_value(t.total) AS total, count(r.v) / any_value(t.total) AS fraction FROM tot t CROSS JOIN cats c LEFT JOIN r ON r.grp = t.grp AND r.v = c.value GROUP BY t.grp, c.value"""
)
def host_composition(spark, d):
    """A dense grid of groups and categories."""
    return reports.composition(B.alignment(spark, d), _augmented(spark, d), "host_group", M.HOST_GROUPS)


@query(
    f"""WITH {AUGMENTED} SELECT clade, count(*) FILTER (WHERE host_group = 'human') AS human, count(*) FILTER (WHERE host_group = 'avian') AS avian, count(*) FILTER (WHERE host_group = 'swine') AS swine,
count(*) FILTER (WHERE host_group = 'bovine') AS bovine, count(*) FILTER (WHERE host_group = 'other') AS other FROM aug JOIN (SELECT isolate_id, clade FROM meta) USING (isolate_id) GROUP BY clade"""
)
def host_pivot(spark, d):
    """A12."""
    return relational.pivot_counts(_augmented(spark, d), ["clade"], "host_group", M.HOST_GROUPS)


@query(
    f"""WITH {B.DATED}, {B.ALIGNMENT}, ids AS (SELECT DISTINCT grp, id FROM msa WHERE NOT is_ref), r AS (SELECT i.*, x.d FROM ids i LEFT JOIN dated x ON x.isolate_id = i.id),
g AS (SELECT grp, list_sort(list(d) FILTER (WHERE d IS NOT NULL)) AS l FROM r GROUP BY grp), m AS (SELECT grp, l[len(l) // 2 + 1] AS m FROM g)
SELECT grp, count(*) AS total, count(d) AS valid, count(*) - count(d) AS missing, coalesce(strftime(any_value(m), '%Y-%m-%d'), 'N/A') AS median,
count(*) FILTER (WHERE d <= m) AS n_early, count(*) FILTER (WHERE d > m) AS n_late FROM r JOIN m USING (grp) GROUP BY grp"""
)
def temporal_summary(spark, d):
    """A13, A6."""
    return reports.temporal_summary(B.alignment(spark, d), _meta(spark, d))


@query(
    f"""WITH {AUGMENTED}, {B.ALIGNMENT}, hits AS (SELECT DISTINCT a.geographic_group AS value, m.grp, m.id FROM msa m JOIN aug a ON a.isolate_id = m.id WHERE NOT m.is_ref),
both_ AS (SELECT * FROM hits UNION SELECT DISTINCT value, grp, '{B.ROOT}' FROM hits)
SELECT value, grp, CAST(row_number() OVER (PARTITION BY value, grp ORDER BY id <> '{B.ROOT}', id) AS INT) AS ord, id FROM both_"""
)
def geographic_samples(spark, d):
    """Lists for all groups and values at once."""
    return samples.value_samples(B.alignment(spark, d), _augmented(spark, d), "geographic_group", B.ROOT)


@query(
    f"""WITH {B.DATED}, {B.ALIGNMENT}, ids AS (SELECT DISTINCT grp, id FROM msa WHERE NOT is_ref), r AS (SELECT i.*, x.d FROM ids i LEFT JOIN dated x ON x.isolate_id = i.id),
g AS (SELECT grp, list_sort(list(d) FILTER (WHERE d IS NOT NULL)) AS l FROM r GROUP BY grp), m AS (SELECT grp, l[len(l) // 2 + 1] AS m FROM g),
hits AS (SELECT CASE WHEN d <= m THEN 'early' ELSE 'late' END AS value, grp, id FROM r JOIN m USING (grp) WHERE d IS NOT NULL),
both_ AS (SELECT * FROM hits UNION SELECT v, grp, '{B.ROOT}' FROM m, (VALUES ('early'), ('late')) t(v))
SELECT value, grp, CAST(row_number() OVER (PARTITION BY value, grp ORDER BY id <> '{B.ROOT}', id) AS INT) AS ord, id FROM both_"""
)
def temporal_samples(spark, d):
    """Each tree's own median."""
    return samples.temporal_samples(B.alignment(spark, d), _meta(spark, d), B.ROOT)


_IDENT = B.ALIGNMENT + """, ref AS (SELECT grp, seq AS r FROM msa WHERE is_ref),
ident AS (SELECT m.grp, m.id, 100.0 * list_sum(list_transform(list_zip(string_split(m.seq, ''), string_split(r.r, '')), lambda z: CASE WHEN z[1] = z[2] THEN 1 ELSE 0 END)) / length(r.r) AS identity
  FROM msa m JOIN ref r USING (grp) WHERE NOT m.is_ref)"""


@query(f"WITH {_IDENT} SELECT grp, id, round(identity, 6) AS identity FROM ident")
def sequence_identity(spark, d):
    """A19, J10."""
    return reports.identity(B.alignment(spark, d)).withColumn("identity", F.round("identity", 6))


@query(f"WITH {_IDENT} SELECT grp, count(*) AS n, round(quantile_cont(identity, 0.5), 6) AS median_identity FROM ident GROUP BY grp")
def identity_medians(spark, d):
    """The interpolated median."""
    return reports.identity_summary(reports.identity(B.alignment(spark, d))).withColumn("median_identity", F.round("median_identity", 6))


@query(
    """WITH x AS (SELECT l_returnflag AS flag, 100 * (1 - l_discount * 2.5) AS v FROM lineitem), b AS (SELECT flag, CASE WHEN v = 100 THEN 50 WHEN v >= 70 AND v < 100 THEN CAST(floor((v - 70) / (30.0 / 50)) AS INT) + 1 END AS bin FROM x),
g AS (SELECT flag, bin, count(*) AS n FROM b GROUP BY ALL) SELECT flag, bin, n, pct FROM (SELECT *, 100.0 * n / sum(n) OVER (PARTITION BY flag) AS pct FROM g) WHERE bin IS NOT NULL"""
)
def identity_histogram(spark, d):
    """50 bins from 70 to 100, the last one closed."""
    x = B.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), (100 * (1 - F.col("l_discount") * 2.5)).alias("v"))
    return relational.histogram(x, "v", 70, 100, 50, ["flag"])


_SITES = B.ALIGNMENT + """, mk AS (SELECT grp, id, is_ref, regexp_replace(seq, '[^ACGT-]', 'N', 'g') AS s FROM msa), ref AS (SELECT grp, s AS r FROM mk WHERE is_ref),
z AS (SELECT grp, unnest(list_zip(string_split(m.s, ''), string_split(r.r, ''), range(1, greatest(length(m.s), length(r.r)) + 1))) AS t FROM mk m JOIN ref r USING (grp) WHERE NOT is_ref),
e AS (SELECT grp, t[3] AS pos, t[2] AS ref, t[1] AS alt FROM z WHERE t[1] <> t[2] AND t[1] <> '-' AND t[2] <> '-')"""


@query(
    f"""WITH {_SITES} SELECT grp, CAST(pos AS INT) AS pos, ref, coalesce(array_to_string(list_sort(list(DISTINCT alt) FILTER (WHERE alt <> 'N')), ','), '') AS alts,
count(*) FILTER (WHERE alt <> 'N') AS n_alt, count(*) FILTER (WHERE alt = 'N') AS n_missing FROM e GROUP BY grp, pos, ref"""
)
def variant_sites(spark, d):
    """T1, D12, R13, K10."""
    return variants.variant_sites(B.alignment(spark, d))


@query(
    f"""WITH {_SITES}, s AS (SELECT grp, pos, ref, coalesce(array_to_string(list_sort(list(DISTINCT alt) FILTER (WHERE alt <> 'N')), ','), '') AS alts FROM e GROUP BY grp, pos, ref),
a AS (SELECT *, CASE WHEN alts = '' THEN '.' ELSE alts END AS alt FROM s)
SELECT CAST(pos AS INT) AS pos, concat_ws(chr(9), 'Reference', CAST(pos AS VARCHAR), ref || pos || alt, ref, alt, '.', '.', '.') AS line FROM a"""
)
def vcf_text(spark, d):
    """Body lines of all groups' sites."""
    return variants.vcf_lines(variants.variant_sites(B.alignment(spark, d)))


@query(
    f"""WITH {_SITES}, mk2 AS (SELECT grp, ord, id, is_ref, regexp_replace(seq, '[^ACGT-]', 'N', 'g') AS s FROM msa), ns AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY ord) AS k FROM mk2 WHERE NOT is_ref),
st AS (SELECT grp, pos, ref, coalesce(list_sort(list(DISTINCT alt) FILTER (WHERE alt <> 'N')), []) AS alts FROM e GROUP BY grp, pos, ref),
ge AS (SELECT st.grp, pos, ref, alts, string_agg(CASE WHEN substr(ns.s, pos, 1) IN (ref, '-', '') THEN '0' WHEN substr(ns.s, pos, 1) = 'N' THEN '.' ELSE CAST(list_position(alts, substr(ns.s, pos, 1)) AS VARCHAR) END, chr(9) ORDER BY k) AS g
  FROM st JOIN ns ON ns.grp = st.grp GROUP BY st.grp, pos, ref, alts),
hd AS (SELECT grp, string_agg(id, chr(9) ORDER BY k) AS ids FROM ns GROUP BY grp)
SELECT grp, CAST(pos AS BIGINT) AS ord, md5(concat_ws(chr(9), 'Reference', pos, ref || pos || al, ref, al, '.', '.', '.', 'GT', g)) AS digest FROM (SELECT *, CASE WHEN len(alts) = 0 THEN '.' ELSE array_to_string(alts, ',') END AS al FROM ge)
UNION ALL SELECT grp, -4, md5('##fileformat=VCFv4.2') FROM hd UNION ALL SELECT grp, -3, md5('##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">') FROM hd UNION ALL SELECT grp, -2, md5('##contig=<ID=Reference>') FROM hd
UNION ALL SELECT grp, -1, md5(concat_ws(chr(9), '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', ids)) FROM hd"""
)
def vcf_documents(spark, d):
    """Whole VCF documents, a digest per line, with a genotype for every sample."""
    return variants.vcf_document(B.alignment(spark, d)).select("grp", "ord", F.md5(F.col("line").cast("binary")).alias("digest"))


@query("SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def customers_without_large_orders(spark, d):
    """J1, X2 where some ids do lack a partner."""
    orders = B.table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("id"))
    return relational.missing_ids(B.table(spark, d, "customer").select(F.col("c_custkey").alias("id")), orders, "id")


@query(
    """WITH c AS (SELECT DISTINCT c_custkey AS id FROM customer), o AS (SELECT DISTINCT o_custkey + 5 AS id FROM orders)
SELECT id, 'left' AS side FROM c WHERE id NOT IN (SELECT id FROM o) UNION ALL SELECT id, 'right' FROM o WHERE id NOT IN (SELECT id FROM c)"""
)
def unequal_key_sets(spark, d):
    """Ids that one of two tables has, with the side."""
    return relational.same_keys(B.table(spark, d, "customer").select(F.col("c_custkey").alias("id")), B.table(spark, d, "orders").select((F.col("o_custkey") + 5).alias("id")), "id")


@query("SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 5000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def shared_nations(spark, d):
    """X3."""
    rich = lambda t, p: B.table(spark, d, t).where(F.col(f"{p}_acctbal") > 5000).select(F.col(f"{p}_nationkey").alias("nation"))
    return rich("customer", "c").intersect(rich("supplier", "s"))


@query("SELECT 0 AS frame, s_suppkey AS row, s_name AS name FROM supplier UNION ALL SELECT 1, c_custkey, c_name FROM customer")
def names_in_order(spark, d):
    """Two tables under each other, the first one's rows first."""
    part = lambda t, p, k: B.table(spark, d, t).select(F.col(k).alias("ord"), F.col(f"{p}_name").alias("name"))
    out = relational.union_in_order([part("supplier", "s", "s_suppkey"), part("customer", "c", "c_custkey")])
    return out.select("ord.frame", "ord.row", "name")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10")
def first_rows(spark, d):
    """The first rows of an order, a top-k without a full sort."""
    rows = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rows.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(10)


@query(
    """WITH f AS (SELECT l_orderkey AS grp, l_linenumber % 3 AS kind, l_partkey % 900 + 1 AS s, l_partkey % 900 + 1 + l_suppkey % 300 AS e FROM lineitem)
SELECT grp, CAST(min(s) AS INT) AS min_start, CAST(max(e) AS INT) AS max_end FROM f WHERE kind < 2 GROUP BY grp"""
)
def feature_spans(spark, d):
    """From the first to the last base of each region's genes and coding parts, from GFF lines."""
    li = B.table(spark, d, "lineitem")
    start = F.col("l_partkey") % 900 + 1
    kind = F.when(F.col("l_linenumber") % 3 == 0, "gene").when(F.col("l_linenumber") % 3 == 1, "CDS").otherwise("exon")
    line = F.concat_ws("\t", F.lit("seg"), F.lit("x"), kind, start.cast("string"), (start + F.col("l_suppkey") % 300).cast("string"), F.lit("."), F.lit("+"), F.lit("0"), F.concat(F.lit("ID=f"), F.col("l_linenumber").cast("string")))
    feats = T.parse_gff(li.select(F.struct("l_orderkey", "l_linenumber").alias("ord"), line.alias("line")))
    return curate.feature_span(feats.withColumn("grp", F.col("ord.l_orderkey")))


@query(
    """WITH v AS (SELECT c_custkey AS k, t, CASE WHEN (c_custkey + t) % 3 = 0 THEN 'A' WHEN c_custkey * t % 2 = 0 THEN 'C' ELSE 'G' END AS base FROM customer, range(5) r(t)),
w AS (SELECT k, base, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, min(t)) AS rn FROM v GROUP BY k, base), s AS (SELECT k, repeat('A', CAST(k % 50 AS INT)) || base || repeat('A', CAST(59 - k % 50 AS INT)) AS seq FROM w WHERE rn = 1)
SELECT CAST(row_number() OVER (ORDER BY k <> 1, 'c' || k) AS INT) AS ord, 'c' || k AS leaf, seq FROM s"""
)
def consensus_from_differences(spark, d):
    """The consensus of five trees from their leaves' differences, in order, the reference first."""
    k = F.col("c_custkey")
    base = F.when((k + F.col("tree")) % 3 == 0, "A").when(k * F.col("tree") % 2 == 0, "C").otherwise("G")
    rows = B.table(spark, d, "customer").select(k, F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree")).withColumn("alt", base)
    one = F.array(F.struct(F.lit("A").alias("ref"), (k % 50 + 1).cast("int").alias("pos"), F.col("alt").alias("alt")))
    leaves = rows.select(F.concat(F.lit("c"), k.cast("string")).alias("leaf"), "tree", F.filter(one, lambda m: m["alt"] != "A").alias("muts"))
    return variants.ordered_consensus(variants.consensus_differences(leaves), "c1", "A" * 60)


_VOTES = f"""c AS (SELECT conv_id AS leaf, turn, translate(text, '{B.ALPHABET}', '{B.BASES_OF}') AS s FROM conversations WHERE text IS NOT NULL),
z AS (SELECT leaf, turn, unnest(list_zip(string_split(s, ''), range(1, length(s) + 1))) AS t FROM c), v AS (SELECT leaf, t[2] AS pos, t[1] AS base, count(*) AS n, min(turn) AS f FROM z WHERE t[1] <> '' GROUP BY ALL),
b AS (SELECT leaf, pos, base, row_number() OVER (PARTITION BY leaf, pos ORDER BY n DESC, f) AS rn FROM v)"""


@query(f"WITH {_VOTES} SELECT leaf, string_agg(base, '' ORDER BY pos) AS consensus FROM b WHERE rn = 1 GROUP BY leaf")
def tree_consensus(spark, d):
    """Ties go to the earliest tree."""
    return variants.consensus(B.consensus_rows(spark, d))


@query(
    """WITH n AS (SELECT count(DISTINCT turn) AS n FROM conversations WHERE text IS NOT NULL)
SELECT conv_id AS leaf, count(DISTINCT turn) AS n_trees FROM conversations WHERE text IS NOT NULL GROUP BY conv_id HAVING count(DISTINCT turn) <> (SELECT n FROM n)"""
)
def leaf_set_differences(spark, d):
    """J8, X4."""
    return variants.leaf_sets_differ(B.consensus_rows(spark, d))


@query(f"WITH {B.METADATA}, {B.ALIGNMENT} SELECT DISTINCT id FROM msa WHERE id NOT IN (SELECT isolate_id FROM meta)")
def missing_metadata(spark, d):
    """Aligned isolates without metadata."""
    return relational.missing_ids(B.alignment(spark, d), _meta(spark, d).select(S.sanitize_id("isolate_id").alias("id")), "id")


# --- order, sampling ---------------------------------------------------------------------------------------------


@query()
def seeded_permutations(spark, d):
    """Ten seeded orders of each group with the reference on top."""
    return relational.permute(B.alignment(spark, d).select("grp", "id", "is_ref"), 10, "id", "is_ref", ["grp"]).select("grp", "seed", "new_ord", "id")


@query(
    f"""WITH {B.ALIGNMENT}, g AS (SELECT grp, count(*) AS n FROM msa GROUP BY grp), s AS (SELECT CAST(unnest(range(10)) AS INT) AS seed)
SELECT grp, seed, n AS n_rows, n AS n_ids, 1 AS first_place, CAST(n AS INT) AS last_place, 1 AS reference_place, CAST(n * (n + 1) // 2 AS BIGINT) AS places, true AS differs FROM g, s"""
)
def permutation_invariants(spark, d):
    """Each seed's order holds every row once, places 1 to n, the reference on top, and no two seeds agree."""
    p = relational.permute(B.alignment(spark, d).select("grp", "id", "is_ref"), 10, "id", "is_ref", ["grp"])
    rows = p.groupBy("grp", "seed").agg(
        F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.min("new_ord").alias("first_place"), F.max("new_ord").alias("last_place"),
        F.min(F.when(F.col("is_ref"), F.col("new_ord"))).alias("reference_place"), F.sum("new_ord").alias("places"), F.bit_xor(F.xxhash64("id", "new_ord")).alias("mark"),
    )
    marks = rows.groupBy("grp").agg((F.countDistinct("mark") == F.count("*")).alias("differs"))
    return rows.drop("mark").join(marks, "grp")


@query(f"WITH {B.ALIGNMENT} SELECT grp, least(count(*) FILTER (WHERE NOT is_ref), 1000) AS n_drawn, count(*) FILTER (WHERE is_ref) AS n_references, true AS all_there FROM msa GROUP BY grp")
def sample_invariants(spark, d):
    """Up to 1000 rows of each group beside the reference, all of them rows of the alignment."""
    rows = B.alignment(spark, d).select("grp", "id", "is_ref")
    drawn = relational.sample_rows(rows, 1000, "id", "is_ref", ["grp"])
    known = drawn.join(rows.select("grp", "id").withColumn("_there", F.lit(True)), ["grp", "id"], "left")
    return known.groupBy("grp").agg(F.count_if(~F.col("is_ref")).alias("n_drawn"), F.count_if("is_ref").alias("n_references"), F.bool_and(F.coalesce("_there", F.lit(False))).alias("all_there"))


@query()
def identity_sample(spark, d):
    """Up to 1000 rows of each group beside the reference, a sampling operator."""
    return relational.sample_rows(B.alignment(spark, d).select("grp", "id", "is_ref"), 1000, "id", "is_ref", ["grp"])


@query(f"WITH {B.LOGS} SELECT label, CAST(row_number() OVER (ORDER BY CASE WHEN label LIKE 'HA%' THEN 0 WHEN label LIKE 'NA%' THEN 1 ELSE 2 END, label) AS INT) AS place, regexp_replace(label, '_(.*)$', ' (\\1)') AS shown FROM (SELECT DISTINCT label FROM labelled)")
def ordered_labels(spark, d):
    """O7, O10, C19, A15."""
    from pyspark.sql import Window as W

    rows = B.logs(spark, d).select("label").distinct()
    shown = M.group_label(F.split_part("label", F.lit("_"), F.lit(1)), F.split_part("label", F.lit("_"), F.lit(2)))
    return rows.select("label", F.row_number().over(W.orderBy(*M.label_order("label"))).alias("place"), shown.alias("shown"))


@query(
    """SELECT k, CAST(1000 + k % 5000 AS BIGINT) AS total, CAST(1000 + k % 5000 - k % 700 AS BIGINT) AS passed, CAST(k % 700 AS BIGINT) AS failed, (1000 + k % 5000 - k % 700) / (1000 + k % 5000) AS frac_passed
FROM (SELECT event_id AS k FROM events)"""
)
def curation_logs(spark, d):
    """Counts read from log texts."""
    logs = B.logs(spark, d).select(F.col("event_id").cast("string").alias("label"), F.col("curated").alias("text"))
    return reports.curation_log(logs).select(F.col("label").cast("long").alias("k"), "total", "passed", "failed", "frac_passed")


@query(
    f"""WITH {B.LOGS}, s AS (SELECT label, kind, CASE WHEN kind = 'merged' THEN 1000 + k % 97 ELSE 1000 + k % 83 END AS lo FROM labelled), g AS (SELECT label, CAST(min(lo) FILTER (WHERE kind = 'individual') AS BIGINT) AS best_individual,
CAST(min(lo) FILTER (WHERE kind = 'merged') AS BIGINT) AS merged FROM s GROUP BY label) SELECT *, merged - best_individual AS improvement FROM g WHERE best_individual IS NOT NULL AND merged IS NOT NULL"""
)
def parsimony_improvements(spark, d):
    """Read from log texts of single and merged graphs."""
    return reports.improvements(reports.graph_log(B.logs(spark, d)))


@query(f"WITH {B.LOGS} SELECT k, CAST(k % 60 AS INT) AS magnitude FROM labelled")
def tree_count_magnitudes(spark, d):
    """C20: counts too large for numbers stay text."""
    logs = B.logs(spark, d).select(F.col("event_id").cast("string").alias("label"), "kind", "text")
    return reports.graph_log(logs).select(F.col("label").cast("long").alias("k"), "magnitude")


# --- trees -------------------------------------------------------------------------------------------------------

@query(f"WITH {_WALK} SELECT node, path FROM w")
def mutation_paths(spark, d):
    """The path of every leaf."""
    e = materialize(B.tree(spark, d), "tree")
    p = tree.paths(e).join(tree.leaves(e).where(F.col("node").startswith("c")), ["tree_id", "node"], "left_semi")
    return p.select("node", tree.path_text("steps").alias("path"))


@query(
    f"""WITH RECURSIVE {B.TREE}, seqs AS (SELECT node, repeat('A', 60) AS s FROM edges WHERE parent IS NULL
UNION ALL SELECT e.node, CASE WHEN e.mut = '' THEN s ELSE substr(s, 1, CAST(substr(mut, 2, length(mut) - 2) AS INT) - 1) || right(mut, 1) || substr(s, CAST(substr(mut, 2, length(mut) - 2) AS INT) + 1) END FROM edges e JOIN seqs ON e.parent = seqs.node)
SELECT node, s AS seq FROM seqs WHERE node LIKE 'c%'"""
)
def leaf_sequences(spark, d):
    """Mutations along each path applied to the reference."""
    e = materialize(B.tree(spark, d), "tree")
    p = tree.paths(e).where(F.col("node").startswith("c"))
    muts = S.parse_path(tree.path_text("steps"))
    return p.select("node", S.apply_mutations(F.lit("A" * 60), muts).alias("seq"))


@query(f"WITH {B.TREE} SELECT node, CAST(depth AS INT) AS depth FROM edges")
def node_depths(spark, d):
    """Levels of the tree by pointer doubling."""
    return tree.depths(materialize(B.tree(spark, d), "tree")).select("node", "depth")


@query(
    f"""WITH {B.TREE}, s AS (SELECT node, parent FROM edges WHERE depth = 3 AND CAST(substr(node, 2) AS INT) % 7 = 0), n AS (SELECT DISTINCT e.node, e.parent FROM edges e JOIN s ON s.parent = e.node), r AS (SELECT DISTINCT e.node, e.parent FROM edges e JOIN n ON n.parent = e.node)
SELECT node, parent FROM s UNION ALL SELECT node, parent FROM n UNION ALL SELECT node, parent FROM r UNION ALL SELECT 'root', NULL"""
)
def induced_subtree(spark, d):
    """Chosen leaves and their ancestors."""
    e = materialize(B.tree(spark, d), "tree")
    chosen = e.where(F.col("node").startswith("c") & (F.substr("node", F.lit(2)).try_cast("int") % 7 == 0)).select("tree_id", "node")
    return tree.induced(e, chosen, collapse=False).select("node", "parent")


@query(
    f"""WITH {B.TREE}, keep AS (SELECT * FROM edges WHERE depth IN (0, 3) OR mut <> '')
SELECT k.node, CASE WHEN k.parent IS NULL THEN NULL WHEN p.depth = 0 OR p.mut <> '' THEN p.node WHEN g.depth = 0 OR g.mut <> '' THEN g.node ELSE 'root' END AS parent
FROM keep k LEFT JOIN edges p ON p.node = k.parent LEFT JOIN edges g ON g.node = p.parent"""
)
def contracted_tree(spark, d):
    """Inner nodes without mutations contracted."""
    return tree.contract(materialize(B.tree(spark, d), "tree")).select("node", "parent")


@query(
    f"""WITH {B.TREE}, l AS (SELECT c.node AS c, n.node AS n, r.node AS r, c.mut AS cm, n.mut AS nm, r.mut AS rm FROM edges c JOIN edges n ON n.node = c.parent JOIN edges r ON r.node = n.parent WHERE c.node = 'c1'),
f AS (SELECT c AS node, NULL AS parent, '' AS mut FROM l UNION ALL SELECT n, c, CASE WHEN cm = '' THEN '' ELSE right(cm, 1) || substr(cm, 2, length(cm) - 2) || left(cm, 1) END FROM l
UNION ALL SELECT r, n, CASE WHEN nm = '' THEN '' ELSE right(nm, 1) || substr(nm, 2, length(nm) - 2) || left(nm, 1) END FROM l UNION ALL SELECT 'root', r, CASE WHEN rm = '' THEN '' ELSE right(rm, 1) || substr(rm, 2, length(rm) - 2) || left(rm, 1) END FROM l)
SELECT node, parent, mut FROM f UNION ALL SELECT node, parent, mut FROM edges WHERE node NOT IN (SELECT node FROM f)"""
)
def rerooted_tree(spark, d):
    """At a leaf; edges on the way are turned and their mutations reversed."""
    e = materialize(B.tree(spark, d), "tree")
    roots = spark.range(1).select(F.lit(1).alias("tree_id"), F.lit("c1").alias("root"))
    mut = F.array_join(F.transform("muts", lambda m: F.concat(m["ref"], m["pos"].cast("string"), m["alt"])), ",")
    return tree.reroot(e, roots).select("node", "parent", mut.alias("mut"))


@query(
    f"""WITH {B.TREE}, n AS (SELECT n.node, n.parent, coalesce('(' || string_agg(c.node, ',' ORDER BY c.node) || ')internal_', '') || n.node AS t FROM edges n LEFT JOIN edges c ON c.parent = n.node WHERE n.depth = 2 GROUP BY n.node, n.parent),
r AS (SELECT r.node, coalesce('(' || string_agg(n.t, ',' ORDER BY n.t) || ')internal_', '') || r.node AS t FROM edges r LEFT JOIN n ON n.parent = r.node WHERE r.depth = 1 GROUP BY r.node)
SELECT '(' || string_agg(t, ',' ORDER BY t) || ')internal_root;' AS newick FROM r"""
)
def newick_text(spark, d):
    """T9, T14, D17, K9."""
    return tree.newick(materialize(B.tree(spark, d), "tree")).select("newick")


@query(f"WITH {B.TREE} SELECT count(*) AS n_nodes, count(*) FILTER (WHERE mut <> '') AS parsimony, (SELECT count(*) FROM edges e WHERE NOT EXISTS (SELECT 1 FROM edges x WHERE x.parent = e.node)) AS n_leaves FROM edges")
def tree_statistics(spark, d):
    """T4, T5: size and parsimony score of a tree."""
    return tree.tree_statistics(materialize(B.tree(spark, d), "tree")).select("n_nodes", F.col("parsimony").alias("parsimony"), "n_leaves")


@query(
    f"""WITH {B.TREE}, {AUGMENTED} SELECT e.node, e.parent, e.mut, a.host_group, a.geographic_group FROM edges e LEFT JOIN aug a ON a.isolate_id = 'EPI_ISL_' || substr(e.node, 2) AND e.depth = 3"""
)
def tree_with_metadata(spark, d):
    """Nodes with the metadata of their isolates, read back from the exported lines."""
    e = B.tree(spark, d).withColumn("node", F.when(F.col("node").startswith("c"), F.concat(F.lit("EPI_ISL_"), F.substr("node", F.lit(2)))).otherwise(F.col("node")))
    rows = tree.export_rows(e, _augmented(spark, d), ["host_group", "geographic_group"])
    back = rows.select(F.from_json("json", "node string, parent string, muts array<struct<ref:string,pos:int,alt:string>>, host_group string, geographic_group string").alias("j"))
    name = F.regexp_replace("j.node", "^EPI_ISL_", "c")
    mut = F.array_join(F.transform("j.muts", lambda m: F.concat(m["ref"], m["pos"].cast("string"), m["alt"])), ",")
    return back.select(name.alias("node"), F.col("j.parent").alias("parent"), mut.alias("mut"), F.col("j.host_group").alias("host_group"), F.col("j.geographic_group").alias("geographic_group"))


_COSTS = f"""st AS (SELECT unnest({B.sql_list(B.STATES)}) AS s),
leaf AS (SELECT c_custkey, 'n' || c_nationkey AS n, CASE WHEN c_custkey % 11 <> 0 THEN {B.sql_list(B.STATES)}[list_position({B.sql_list(B.MARKETS)}, c_mktsegment)] END AS state FROM customer),
nc AS (SELECT e.node AS n, e.parent AS r, s, CAST(coalesce((SELECT count(*) FROM leaf WHERE leaf.n = e.node AND state IS NOT NULL AND state <> s), 0) AS INT) AS c FROM (SELECT 'n' || n_nationkey AS node, 'r' || n_regionkey AS parent FROM nation) e, st),
ng AS (SELECT *, least(c, min(c) OVER (PARTITION BY n) + 1) AS g FROM nc),
rc AS (SELECT r, s, CAST(sum(g) AS INT) AS c FROM ng GROUP BY ALL), rg AS (SELECT *, least(c, min(c) OVER (PARTITION BY r) + 1) AS g FROM rc),
tc AS (SELECT s, CAST(sum(g) AS INT) AS c FROM rg GROUP BY ALL)"""


@query(f"WITH {_COSTS} SELECT min(c) AS score FROM tc")
def parsimony_score(spark, d):
    """The least number of host changes."""
    return parsimony.parsimony_score(materialize(B.tree(spark, d), "tree"), B.leaf_states(spark, d), B.STATES).select("score")


@query(
    f"""WITH {_COSTS}, ro AS (SELECT rg.r, rg.s, rg.c, tc.c - rg.g AS o FROM rg JOIN tc USING (s)), ro2 AS (SELECT r, s, c, least(o, min(o) OVER (PARTITION BY r) + 1) AS o FROM ro),
no AS (SELECT ng.n, ng.s, ng.c, ro2.c + ro2.o - ng.g AS o FROM ng JOIN ro2 ON ro2.r = ng.r AND ro2.s = ng.s), no2 AS (SELECT n, s, c, least(o, min(o) OVER (PARTITION BY n) + 1) AS o FROM no),
lf AS (SELECT 'c' || c_custkey AS node, s, CASE WHEN state IS NULL OR state = s THEN 0 ELSE 1000000 END AS c, n, CASE WHEN state IS NULL OR state = s THEN 0 ELSE 1 END AS g FROM leaf, st),
lo AS (SELECT lf.node, lf.s, lf.c, no2.c + no2.o - lf.g AS o FROM lf JOIN no2 ON no2.n = lf.n AND no2.s = lf.s), lo2 AS (SELECT node, s, c, least(o, min(o) OVER (PARTITION BY node) + 1) AS o FROM lo),
everything AS (SELECT 'root' AS node, s, c AS t FROM tc UNION ALL SELECT r, s, c + o FROM ro2 UNION ALL SELECT n, s, c + o FROM no2 UNION ALL SELECT node, s, c + o FROM lo2)
SELECT node, s AS state FROM (SELECT *, min(t) OVER (PARTITION BY node) AS m FROM everything) WHERE t = m"""
)
def ancestral_hosts(spark, d):
    """Every host that a node has in some cheapest history."""
    return parsimony.ancestral_states(materialize(B.tree(spark, d), "tree"), B.leaf_states(spark, d), B.STATES).select("node", "state")


_SITE_COSTS = """p AS (SELECT unnest([2, 3, 5]) AS pos), st AS (SELECT unnest(['A', 'C', 'G', 'T']) AS s),
lf AS (SELECT pos, 'c' || c_custkey AS node, 'n' || c_nationkey AS n, CASE WHEN c_nationkey % pos <> 0 THEN 'A' WHEN c_custkey % 10 = 0 THEN 'G' ELSE 'T' END AS b FROM customer, p),
lc AS (SELECT pos, n, b, count(*) AS k FROM lf GROUP BY ALL), lt AS (SELECT pos, n, sum(k) AS k FROM lc GROUP BY ALL),
nc AS (SELECT p.pos, 'n' || n_nationkey AS n, 'r' || n_regionkey AS r, s, CASE WHEN lt.k IS NULL THEN CASE WHEN s = 'A' THEN 0 ELSE 1000000 END ELSE lt.k - coalesce(lc.k, 0) END AS c
  FROM nation CROSS JOIN p CROSS JOIN st LEFT JOIN lt ON lt.pos = p.pos AND lt.n = 'n' || n_nationkey LEFT JOIN lc ON lc.pos = p.pos AND lc.n = 'n' || n_nationkey AND lc.b = s),
rc AS (SELECT pos, r, s, sum(g) AS c FROM (SELECT *, least(c, min(c) OVER (PARTITION BY pos, n) + 1) AS g FROM nc) GROUP BY ALL),
tc AS (SELECT pos, s, sum(g) AS c FROM (SELECT *, least(c, min(c) OVER (PARTITION BY pos, r) + 1) AS g FROM rc) GROUP BY ALL),
tb AS (SELECT pos, s AS b FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY c + CAST(s <> 'A' AS INT), s <> 'A', s) AS k FROM tc) WHERE k = 1),
rb AS (SELECT pos, r, s AS b, f FROM (SELECT rc.*, tb.b AS f, row_number() OVER (PARTITION BY rc.pos, r ORDER BY c + CAST(s <> tb.b AS INT), s <> tb.b, s) AS k FROM rc JOIN tb USING (pos)) WHERE k = 1),
nb AS (SELECT pos, n, s AS b, f FROM (SELECT nc.*, rb.b AS f, row_number() OVER (PARTITION BY nc.pos, n ORDER BY c + CAST(s <> rb.b AS INT), s <> rb.b, s) AS k FROM nc JOIN rb ON rb.pos = nc.pos AND rb.r = nc.r) WHERE k = 1),
took AS (SELECT 'root' AS node, pos, 'A' AS f, b FROM tb UNION ALL SELECT r, pos, f, b FROM rb UNION ALL SELECT n, pos, f, b FROM nb UNION ALL SELECT node, lf.pos, nb.b, lf.b FROM lf JOIN nb ON nb.n = lf.n AND nb.pos = lf.pos)"""


@query(f"WITH {B.TREE}, {_SITE_COSTS} SELECT e.node, coalesce(string_agg(t.f || t.pos || t.b, ',' ORDER BY t.pos) FILTER (WHERE t.f <> t.b), '') AS mut FROM edges e LEFT JOIN took t ON t.node = e.node GROUP BY e.node")
def site_mutations(spark, d):
    """Mutations of three sites put on the tree's edges; the leaves' bases follow their keys."""
    e = materialize(B.tree(spark, d), "tree")
    c = B.table(spark, d, "customer")
    at = c.select(F.lit(1).alias("tree_id"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.explode(F.array(*[F.lit(i) for i in (2, 3, 5)])).alias("pos"), "c_nationkey", "c_custkey")
    sites = at.where(F.col("c_nationkey") % F.col("pos") == 0).select("tree_id", "node", "pos", F.lit("A").alias("ref"), F.when(F.col("c_custkey") % 10 == 0, "G").otherwise("T").alias("base"))
    out = parsimony.assign_mutations(e, sites)
    return out.select("node", F.array_join(F.transform("muts", lambda m: F.concat(m["ref"], m["pos"].cast("string"), m["alt"])), ",").alias("mut"))


@query(
    f"""WITH {B.TREE}, leaf AS (SELECT c.node AS l, n.node AS n, r.node AS r FROM edges c JOIN edges n ON n.node = c.parent JOIN edges r ON r.node = n.parent WHERE c.depth = 3),
k AS (SELECT l AS node, l FROM leaf UNION ALL SELECT n, l FROM leaf UNION ALL SELECT r, l FROM leaf UNION ALL SELECT 'root', l FROM leaf) SELECT node, count(*) AS n_leaves FROM k GROUP BY node"""
)
def clade_sizes(spark, d):
    """Leaves below each node, by which equal clades of several trees are found."""
    c = tree.clades(materialize(B.tree(spark, d), "tree"))
    return c.select("node", "n_leaves")


def _graph(spark, d) -> DataFrame:
    """Part of history graph: every region is a node with a clade for each nation, which may hang on any of that nation's three alternatives."""
    n = B.table(spark, d, "nation")
    alt = n.select("n_regionkey", "n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("a"))
    low = alt.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("node"), F.col("n_nationkey").cast("string").alias("clade"), F.concat_ws("_", F.lit("n"), F.col("n_nationkey").cast("string"), F.col("a").cast("string")).alias("child"), ((F.col("n_nationkey") * 7 + F.col("a") * 5) % 4).cast("int").alias("weight"))
    top = B.table(spark, d, "region").select(F.lit("root").alias("node"), F.col("r_regionkey").cast("string").alias("clade"), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("child"), F.lit(1).alias("weight"))
    return top.unionByName(low)


_GRAPH = """g AS (SELECT 'root' AS node, CAST(r_regionkey AS VARCHAR) AS clade, 'r' || r_regionkey AS child, 1 AS weight FROM region
UNION ALL SELECT 'r' || n_regionkey, CAST(n_nationkey AS VARCHAR), 'n_' || n_nationkey || '_' || a, CAST((n_nationkey * 7 + a * 5) % 4 AS INT) FROM nation, range(3) t(a))"""


@query(f"WITH {_GRAPH} SELECT node, clade, child, weight FROM (SELECT *, min(weight) OVER (PARTITION BY node, clade) AS m FROM g) WHERE weight = m")
def trimmed_graph(spark, d):
    """Edges of the cheapest histories."""
    return parsimony.trim(_graph(spark, d), "root")


@query()
def sampled_history(spark, d):
    """One history of the trimmed graph, by seed, every one as likely as any other."""
    g = materialize(parsimony.trim(_graph(spark, d), "root"), "trimmed")
    seeds = spark.range(7, 8).withColumnRenamed("id", "seed")
    return histories.sample_histories(g, histories.count_histories(g), seeds, "root").select("node", "clade", "child", "weight")


def _customer_graph(spark, d) -> DataFrame:
    """A graph of histories over customers: each is a clade of its nation with two to four alternatives, some of equal weight."""
    c = B.table(spark, d, "customer")
    k = F.col("c_custkey")
    alt = c.select("c_nationkey", "c_custkey", F.explode(F.sequence(F.lit(0), (k % 3 + 1).cast("int"))).alias("a"))
    low = alt.select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("node"), k.cast("string").alias("clade"), F.concat_ws("_", k.cast("string"), F.col("a").cast("string")).alias("child"), ((k + F.col("a") * 3) % 4).cast("int").alias("weight"))
    top = c.select(F.lit("root").alias("node"), F.col("c_nationkey").cast("string").alias("clade"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("child"), F.lit(1).alias("weight")).distinct()
    return top.unionByName(low)


_COUNTS_SQL = """g AS (SELECT 'n' || c_nationkey AS node, c_custkey AS clade, a, CAST((c_custkey + a * 3) % 4 AS INT) AS weight FROM customer, range(4) t(a) WHERE a <= c_custkey % 3 + 1),
lo AS (SELECT *, min(weight) OVER (PARTITION BY node, clade) AS m FROM g), f AS (SELECT node, clade, count(*) AS k FROM lo WHERE weight = m GROUP BY ALL),
n AS (SELECT node, list_reduce(list_prepend(CAST(1 AS BIGINT), list(k)), lambda x, y: x * y % 2147483647) AS count_mod, sum(log2(k)) AS bits FROM f GROUP BY node)"""


@query(
    f"""WITH {_COUNTS_SQL} SELECT node, count_mod, round(bits, 6) AS bits FROM n
UNION ALL SELECT 'root', list_reduce(list_prepend(CAST(1 AS BIGINT), list(count_mod)), lambda x, y: x * y % 2147483647), round(sum(bits), 6) FROM n"""
)
def history_counts(spark, d):
    """T5: exact numbers of cheapest histories below every inner node, told by their logarithm and one residue."""
    counts = histories.count_histories(parsimony.trim(_customer_graph(spark, d), "root"))
    rows = counts.nodes.where((F.col("node") == "root") | F.col("node").startswith("n"))
    return rows.select("node", F.get("residues", F.lit(0)).alias("count_mod"), F.round(F.col("log_n") / F.log(F.lit(2.0)), 6).alias("bits"))


def _randomized_trees(spark, d) -> DataFrame:
    """Ten trees of all customers; in tree t every seventh customer hangs on another nation."""
    e = materialize(B.tree(spark, d), "tree")
    c = e.where(F.col("node").startswith("c"))
    inner = e.where(~F.col("node").startswith("c"))
    t = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("t")
    key = F.substr("node", F.lit(2)).cast("int")
    nation = F.concat(F.lit("n"), F.when(key % 7 == 0, (F.substr("parent", F.lit(2)).cast("int") + F.col("t")) % 25).otherwise(F.substr("parent", F.lit(2)).cast("int")).cast("string"))
    moved = c.select(t, "node", "parent", "muts").select(F.col("t").alias("tree_id"), "node", nation.alias("parent"), "muts")
    # Nations that a tree leaves without customers go.
    full = moved.select("tree_id", F.col("parent").alias("node")).distinct()
    same = inner.select(t, "node", "parent", "muts").select(F.col("t").alias("tree_id"), "node", "parent", "muts")
    nations = same.where(F.col("node").startswith("n")).join(full, ["tree_id", "node"], "left_semi")
    regions = same.where(~F.col("node").startswith("n") & (F.col("node") != "root")).join(nations.select("tree_id", F.col("parent").alias("node")).distinct(), ["tree_id", "node"], "left_semi")
    return same.where("node = 'root'").unionByName(regions).unionByName(nations).unionByName(moved)


@query(
    f"""WITH {B.TREE}, l AS (SELECT t, c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN (c_nationkey + t) % 25 ELSE c_nationkey END AS n FROM customer, range(10) r(t)),
cl AS (SELECT t, 'n' || n AS node, string_agg(k, ',' ORDER BY k) AS s, min(k) AS lo, count(*) AS n FROM l GROUP BY t, n UNION ALL SELECT t, 'r' || n_regionkey, string_agg(k, ',' ORDER BY k), min(k), count(*) FROM l JOIN nation ON n_nationkey = n GROUP BY t, n_regionkey
  UNION ALL SELECT t, 'root', string_agg(k, ',' ORDER BY k), min(k), count(*) FROM l GROUP BY t UNION ALL SELECT t, 'c' || k, CAST(k AS VARCHAR), k, 1 FROM l),
ed AS (SELECT t, 'c' || k AS node, 'n' || n AS parent FROM l UNION ALL SELECT DISTINCT t, 'n' || n, 'r' || n_regionkey FROM l JOIN nation ON n_nationkey = n UNION ALL SELECT DISTINCT t, 'r' || n_regionkey, 'root' FROM l JOIN nation ON n_nationkey = n)
SELECT u.lo AS first_leaf, u.n AS n_leaves, v.lo AS child_first_leaf, v.n AS child_n_leaves, CAST(e.mut <> '' AS INT) AS weight, count(DISTINCT ed.t) AS n_trees
FROM ed JOIN edges e ON e.node = ed.node JOIN cl u ON u.t = ed.t AND u.node = ed.parent JOIN cl v ON v.t = ed.t AND v.node = ed.node GROUP BY u.s, v.s, u.lo, u.n, v.lo, v.n, e.mut <> ''"""
)
def merged_trees(spark, d):
    """Ten randomised trees merged by their clades, edges that trees share once."""
    e = materialize(_randomized_trees(spark, d), "randomized")
    key = F.when(F.col("node").startswith("c"), F.substr("node", F.lit(2)).cast("long"))
    return tree.merge_trees(e, key).select("first_leaf", "n_leaves", "child_first_leaf", "child_n_leaves", "weight", "n_trees")


@query(
    f"""WITH {B.RECORDS}, c AS (SELECT segment, grp, count(DISTINCT id) AS n FROM grouped WHERE NOT malformed AND grp IS NOT NULL GROUP BY ALL)
SELECT segment, grp, 'acc_' || segment || '_' || grp AS accession, CASE WHEN segment = 'HA' AND grp IN ('H1', 'H3') THEN 'root_' || grp ELSE '' END AS root, n FROM c
WHERE (segment = 'HA' AND grp IN ('H1', 'H3', 'H5')) OR (segment = 'NA' AND grp IN ('N1', 'N2')) OR segment IN ('PB2', 'PB1')"""
)
def configured_groups(spark, d):
    """The records' groups that are configured and have an accession, with their new root; H9 and NS have none."""
    names = ["HA_H1", "HA_H3", "HA_H5", "NA_N1", "NA_N2", "PB2_all", "PB1_all"]
    config = T.Config(segments=["PB2", "PB1", "HA", "NA", "NS"], ha_subtypes=["H1", "H3", "H5", "H9"], na_subtypes=["N1", "N2"], references={n: f"acc_{n}" for n in names}, reroot={"HA_H1": "root_H1", "HA_H3": "root_H3"})
    counts = samples.parse_records(B.records(spark, d))[0].groupBy("segment", "grp").agg(F.count("*").alias("n"))
    return T.lookup(counts.join(T.combinations(spark, config), ["segment", "grp"]), config.reroot, "root").select("segment", "grp", "accession", "root", "n")


@query(
    f"""WITH RECURSIVE {B.TREE}, seqs AS (SELECT node, repeat('A', 60) AS s FROM edges WHERE parent IS NULL
UNION ALL SELECT e.node, CASE WHEN e.mut = '' THEN s ELSE substr(s, 1, CAST(substr(mut, 2, length(mut) - 2) AS INT) - 1) || right(mut, 1) || substr(s, CAST(substr(mut, 2, length(mut) - 2) AS INT) + 1) END FROM edges e JOIN seqs ON e.parent = seqs.node)
SELECT node AS grp, CASE WHEN moved THEN node ELSE 'ref' END AS root, CASE WHEN moved THEN s ELSE repeat('A', 60) END AS root_seq, CASE WHEN moved THEN 1 ELSE 0 END AS gap_fills
FROM (SELECT *, CAST(substr(node, 2) AS INT) % 9 <> 0 AS moved FROM seqs WHERE node LIKE 'c%')"""
)
def root_sequences(spark, d):
    """One root sequence per customer of the tree, checked against its alignment row."""
    e = materialize(B.tree(spark, d), "tree")
    p = materialize(tree.paths(e).where(F.col("node").startswith("c")).select(F.col("node").alias("grp"), F.lit(0).alias("ord"), F.col("node").alias("sample"), tree.path_text("steps").alias("path")), "paths")
    reference = p.select("grp", F.lit("ref").alias("ref_id"), F.lit("A" * 60).alias("ref_seq"))
    roots = p.select("grp", F.when(F.substr("grp", F.lit(2)).cast("int") % 9 != 0, F.col("grp")).alias("root"))
    seq = S.apply_mutations(F.lit("A" * 60), S.parse_path("path"))
    msa = p.select("grp", F.col("sample").alias("id"), F.overlay(seq, F.lit("-"), F.lit(60), F.lit(1)).alias("seq"))
    return variants.root_sequence(reference, p, msa, roots)
