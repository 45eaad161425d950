"""Parsers over text lines (file, line_no, value), file listings and saved JSON answers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.functions.columns import number, ratio, safe_name, yes
from targetlens.functions.ordering import value_ranks
from targetlens.session import cut_lineage

# Residue names, file-name tokens and label rules.
WATER_NAMES = ("HOH", "WAT", "DOD")
ION_NAMES = (
    "HOH", "WAT", "DOD", "CL", "NA", "K", "MG", "CA", "ZN", "SO4", "PO4", "GOL", "EDO", "ACT", "FMT",
    "DMS", "PEG", "IOD", "BR", "CO", "CU", "FE", "MN", "NI",
)
SKIPPED_TOKENS = ("normalized", "tpm", "fpkm", "rpkm", "cpm", "natural_log", "series_matrix")
METADATA_FILES = r"samples|metadata|cellinfo|cell_info|phenotype|celltype|annotation"
MATRIX_FILES = (
    r"matrix|\.mtx|counts?|read_counts|umi_counts|rna[-_ ]?seq|rnaseq|expression|"
    r"\.rds$|\.h5ad$|\.h5$|\.loom$"
)
CONTAINER_FILES = r"\.(?:rds|h5|h5ad|loom)$"
ARCHIVE_FILES = r"\.(?:tar|tar\.gz|tgz|tar\.bz2|tbz2|tar\.xz|txz)$"
SINGLE_CELL_FILES = (
    r"(?i)(?:^|[/_. -])filtered[-_. ]?feature[-_. ]?bc[-_. ]?matrix"
    r"|(?:^|[/_. -])raw[-_. ]?feature[-_. ]?bc[-_. ]?matrix"
    r"|(?:^|[/_. -])single[-_. ]?cell|singlecell"
    r"|scrna|scrnaseq|cellranger|10xgenomics|seurat|singlecellexperiment"
)
BULK_COUNT_FILES = r"(?i)(?:^|/)GSM\d+_[^/]+\.(?:txt|tsv|csv)(?:\.gz)?$"
BARCODE_HEADER = r"^[ACGTN]+([.-]|$)|^[ACGTN]+[0-9]+$|^[A-Z0-9]+_[A-Z0-9]+"
# (pattern on the lower-case file name, label); the first match wins.
FILE_GROUP_RULES = (
    (r"(?=.*control).*etoh", "EtOH"), (r"(?=.*control).*alcohol", "Control"), (r"dmso", "DMSO"),
    (r"jte[-_ ]?607", "JTE607"), (r"(?=.*control).*fibrosis", "Fibrosis"),
    (r"mash|_m-|_m[0-9]", "MASH"), (r"^.*_n[0-9]|normal", "Normal"), (r"phh", "PHH"),
    (r"cj[0-9]", "CHB"), (r"vector", "Vector"), (r"klf2", "KLF2"), (r"dl-?[0-9]", "Diseased"),
    (r"\bch[-_0-9]", "Diseased"), (r"nl-?[0-9]", "Normal"), (r"tumor", "Tumor"), (r"hcc", "HCC"),
    (r"cca|cholangiocarcinoma", "iCCA"), (r"etoh", "EtOH"), (r"control", "Control"),
    (r"mock", "Mock"), (r"sars|sars-cov|covid", "SARS"), (r"ccrcc[0-9]", "$ccrcc[0-9]"),
    (r"gsm[0-9]+", "$gsm[0-9]+"),
)
TITLE_DISEASE_RULES = (
    (r"non-dfu", "Non-DFU Diabetic"), (r"dfu", "DFU"), (r"non-diabetic", "Non-diabetic"), (r"", "Unknown"),
)
TITLE_TISSUE_RULES = (
    (r"forearm skin", "Forearm skin"), (r"foot skin", "Foot skin"), (r"pbmcs", "PBMCs"), (r"", "Unknown"),
)


def label_by_rules(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first rule whose pattern occurs in the lower-cased text, else empty.

    A label ``$pattern`` stands for the matched text itself.
    """
    low = F.lower(text)
    label = F.lit("")
    for pattern, name in reversed(rules):
        value = F.regexp_extract(low, f"({name[1:]})", 1) if name.startswith("$") else F.lit(name)
        label = F.when(low.rlike(pattern), value).otherwise(label)
    return label


def make_unique(
    names: DataFrame, name: str = "name", position: str = "pos", within: Sequence[str] = ("file",)
) -> DataFrame:
    """Repeats of a name inside a file get .1, .2, ... in position order."""
    keys = [*within, name]
    ranks = value_ranks(names, position, keys).select(*keys, position, F.col("min_rank").alias("_k"))
    return names.join(ranks, [*keys, position]).withColumn(
        name, F.when(F.col("_k") == 1, F.col(name)).otherwise(
            F.concat_ws(".", name, (F.col("_k") - 1).cast("string")))
    ).drop("_k")


def scan_mtx(lines: DataFrame, genes: DataFrame, barcodes: DataFrame) -> DataFrame:
    """(file, gene, cell, value) from coordinate-matrix lines and (file, pos, name) lists.

    Comment lines start with ``%``; the first other line holds the dimensions. Missing names
    become GeneN / CellN.
    """
    body = lines.where(~F.startswith("value", F.lit("%")) & (F.trim("value") != ""))
    # a small table of its own, so that the lines of a file need not meet in one task
    head = cut_lineage(body.groupBy("file").agg(F.min("line_no").alias("_head")))
    parts = F.split(F.trim("value"), r"\s+")
    entries = body.join(head, "file").where(F.col("line_no") > F.col("_head")).select(
        "file", parts[0].cast("long").alias("i"), parts[1].cast("long").alias("j"),
        number(parts[2]).alias("value"),
    )
    named = lambda df, key, out: make_unique(df.where(F.trim("name") != ""), "name", "pos").select(
        "file", F.col("pos").alias(key), F.col("name").alias(out))
    return (
        entries.join(named(genes, "i", "gene"), ["file", "i"], "left")
        .join(named(barcodes, "j", "cell"), ["file", "j"], "left")
        .select(
            "file", F.coalesce("gene", F.concat(F.lit("Gene"), F.col("i").cast("string"))).alias("gene"),
            F.coalesce("cell", F.concat(F.lit("Cell"), F.col("j").cast("string"))).alias("cell"), "value",
        )
    )


def quoted_fields(line: Column, sep: str = ",") -> Column:
    """Fields of a delimited line; a separator inside double quotes does not split, quotes go."""
    outside = re.escape(sep) + r'(?=(?:[^"]*"[^"]*")*[^"]*$)'
    plain = F.when(F.contains(line, F.lit('"')), F.split(line, outside, -1)).otherwise(F.split(line, re.escape(sep), -1))
    return F.transform(plain, lambda f: F.replace(
        F.regexp_replace(F.trim(f), r'^"|"$', ""), F.lit('""'), F.lit('"')))


def scan_gene_csv(lines: DataFrame, sep: str = ",") -> DataFrame:
    """(file, gene, cell, value) from gene x cell text: non-zero entries only.

    The header names the cells; it has no corner field when it starts like a barcode. Its names are
    one row per (file, place) and joined there, so no entry carries the header.
    """
    rows = lines.where("line_no > 1 AND trim(value) <> ''").select("file", quoted_fields(F.col("value"), sep).alias("_f")).select(
        "file", F.col("_f")[0].alias("gene"), F.posexplode(F.slice("_f", F.lit(2), F.size("_f"))).alias("_i", "_v"),
    ).select("file", "gene", "_i", number("_v").alias("value")).where("value <> 0")
    names = quoted_fields(F.col("value"), sep)
    bare = F.col("_h")[0].rlike(BARCODE_HEADER)
    head = lines.where("line_no = 1").select("file", names.alias("_h")).select(
        "file", F.posexplode(F.when(bare, F.col("_h")).otherwise(F.slice("_h", F.lit(2), F.size("_h")))).alias("_i", "cell")
    )
    return rows.join(head, ["file", "_i"], "left").select("file", "gene", "cell", "value")


def merge_matrices(matrices: DataFrame, order: str = "file") -> DataFrame:
    """Entries of the genes common to all files that share a gene with the first file."""
    genes = matrices.select(order, "gene").distinct()
    first = genes.agg(F.min(order)).scalar()
    reference = genes.where(F.col(order) == first).select("gene")
    kept = genes.join(reference, "gene", "left_semi").select(order).distinct()
    n = kept.agg(F.count(F.lit(1))).scalar()
    common = (
        genes.join(kept, order, "left_semi").groupBy("gene").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == n).select("gene")
    )
    return matrices.join(kept, order, "left_semi").join(common, "gene", "left_semi")


def sample_from_barcode(barcode: Column, path: Column) -> Column:
    """Sample label from the barcode suffix, else from the path."""
    suffix = F.regexp_extract(barcode, r"_([A-Za-z0-9]+(?:_[A-Za-z0-9]+)?)$", 1)
    folder = F.regexp_extract(path, r"(?i)([^/]+)/raw_feature_bc_matrix(?:/|$)", 1)
    group = F.regexp_extract(path, r"(G[0-9]+[A-Z]?)", 1)
    series = F.regexp_extract(path, r"(GSM[0-9]+)", 1)
    present = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(present(suffix), present(folder), present(group), present(series), F.lit("Sample1"))


def scan_series_matrix(lines: DataFrame) -> DataFrame:
    """(file, pos, sample, source_name, condition, traits): transposed sample annotation lines.

    The condition is Healthy when the source name says healthy, normal or control, else Disease;
    ``traits`` maps each characteristic to its value; several lines of one are joined by "; ".
    """
    tag = F.regexp_extract("value", r"^!Sample_(\w+)\t", 1)
    cells = F.transform(
        F.split(F.regexp_replace("value", r"^![^\t]*\t", ""), "\t"),
        lambda v: F.regexp_replace(F.trim(v), r'^"|"$', ""),
    )
    rows = lines.select("file", "line_no", tag.alias("tag"), cells.alias("v")).where(
        F.col("tag").isin("title", "source_name_ch1", "characteristics_ch1")
    )
    firsts = rows.groupBy("file", "tag").agg(F.min("line_no").alias("_first"))
    usable = rows.join(firsts, ["file", "tag"]).where(
        (F.col("tag") == "characteristics_ch1") | (F.col("line_no") == F.col("_first"))
    )
    long = usable.select("file", "tag", "line_no", F.col("v")[0].alias("_lead"), F.posexplode("v").alias("pos", "x"))
    key = F.regexp_replace(F.regexp_replace("_lead", r":.*$", ""), r"[^A-Za-z0-9._]", ".")
    value = F.regexp_replace("x", r"^[^:]+:\s*", "")
    pick = lambda t: F.max(F.when(F.col("tag") == t, F.col("x")))
    named = long.groupBy("file", "pos").agg(pick("title").alias("sample"), pick("source_name_ch1").alias("source_name"))
    lines_of = F.array_sort(F.collect_set(F.struct("line_no", value.alias("v"))))
    traits = (
        long.where(F.col("tag") == "characteristics_ch1").groupBy("file", "pos", key.alias("k"))
        .agg(F.array_join(F.array_distinct(F.transform(lines_of, lambda s: s["v"])), "; ").alias("v"))
        .groupBy("file", "pos").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("traits"))
    )
    no_traits = F.create_map().cast("map<string,string>")
    wide = named.join(traits, ["file", "pos"], "left").withColumn("traits", F.coalesce("traits", no_traits))
    healthy = F.lower("source_name").rlike("healthy|normal|control")
    return wide.withColumn(
        "condition", F.when(F.col("source_name").isNotNull(), F.when(healthy, "Healthy").otherwise("Disease"))
    )


# ---- saved database answers -----------------------------------------------------------------


def _list_size(json: Column, path: str) -> Column:
    return F.json_array_length(F.get_json_object(json, path))


def record_count(json: Column) -> Column:
    """Number of records in a compact answer, with the usual fall-backs."""
    counts = [_list_size(json, "$.records"), F.get_json_object(json, "$.pathway_count").try_cast("long")]
    for key in ("total", "count", "hits", "pathways"):
        raw = F.get_json_object(json, f"$.summary.{key}")
        counts += [F.when(raw.rlike(r"^-?\d+$"), raw.try_cast("long")), F.json_array_length(raw)]
    return F.coalesce(*[c.cast("long") for c in counts], F.lit(0).cast("long"))


def head_of(items: Column, limit: int | None) -> Column:
    """The first ``limit`` items, all when it is None."""
    return items if limit is None else F.slice(items, 1, limit)


def record_ids(json: Column, keys: Sequence[str], limit: int | None = None) -> Column:
    """Distinct ids, per record the first non-empty key; the first ``limit`` when given."""
    records = F.from_json(F.get_json_object(json, "$.records"), "array<map<string,string>>")
    first = lambda r: F.coalesce(*[F.nullif(F.try_element_at(r, F.lit(k)), F.lit("")) for k in keys])
    ids = F.array_distinct(F.filter(F.transform(records, first), lambda x: x.isNotNull()))
    return F.array_join(F.coalesce(head_of(ids, limit), F.array().cast("array<string>")), ",")


# Id keys per database section and the evidence columns they fill.
EVIDENCE_SECTIONS = {
    "string": ("string_partners", "string_partner_ids", ("preferredName_B", "stringId_B")),
    "reactome": ("reactome_pathways", "reactome_pathway_ids", ("stId", "id")),
    "pharmgkb": ("pharmgkb_annotations", "pharmgkb_ids", ("id", "accessionId")),
    "alphafold": ("alphafold_structures", "alphafold_ids", ("entryId", "uniprotAccession", "id")),
}


def scan_evidence_json(answers: DataFrame, limit: int | None = None) -> DataFrame:
    """Evidence columns per gene from (gene, section, json)."""
    json = F.col("json")
    ok = F.coalesce(
        F.get_json_object(json, "$.ok") == "true", F.get_json_object(json, "$.status_code") == "200", F.lit(False)
    )
    hits = F.from_json(
        F.get_json_object(json, "$.summary.search.hits"),
        "array<struct<entity: string, object: struct<id: string, approvedSymbol: string>>>",
    )
    target_ids = F.array_distinct(F.filter(
        F.transform(
            F.filter(hits, lambda h: h["entity"] == "target"),
            lambda h: F.coalesce(F.nullif(h["object"]["id"], F.lit("")), F.nullif(h["object"]["approvedSymbol"], F.lit(""))),
        ),
        lambda x: x.isNotNull(),
    ))
    pathways = F.from_json(F.get_json_object(json, "$.pathways"), "array<string>")
    section = F.col("section")
    only = lambda name, c: F.max(F.when(section == name, c))
    zero, none = F.lit(0).cast("long"), F.lit("")
    aggs = []
    for name, (count, ids, keys) in EVIDENCE_SECTIONS.items():
        aggs.append(F.coalesce(only(name, record_count(json)), zero).alias(count))
        aggs.append(F.coalesce(only(name, record_ids(json, keys, limit)), none).alias(ids))
    aggs += [
        F.coalesce(only("opentargets", F.size(target_ids).cast("long")), zero).alias("opentargets_hits"),
        F.coalesce(only("opentargets", F.array_join(head_of(target_ids, limit), ",")), none)
        .alias("opentargets_target_ids"),
        F.coalesce(only("kegg", F.get_json_object(json, "$.pathway_count").try_cast("long")), zero)
        .alias("kegg_pathways"),
        F.coalesce(only("kegg", F.array_join(pathways, ",")), none).alias("kegg_pathway_ids"),
        F.array_join(F.sort_array(F.collect_set(F.when(ok, section))), ",").alias("database_sources"),
    ]
    return answers.groupBy("gene").agg(*aggs)


# Names under which an affinity answer holds its list.
AFFINITY_RESPONSES = (
    "getLindsByPDBsResponse", "getLigandsByPDBsResponse", "getLindsByUniprotsResponse",
    "getLigandsByUniprotsResponse",
)


def scan_affinity_json(documents: DataFrame, limit: int | None = None) -> DataFrame:
    """Ligand rows from saved affinity answers (file, value, target), the first ``limit`` per file when given.

    The list sits at the top or under one of the known response names.
    """
    paths = [F.get_json_object("value", f"$.{n}.affinities") for n in AFFINITY_RESPONSES]
    items = F.from_json(
        F.coalesce(*paths, F.get_json_object("value", "$.affinities")), "array<map<string,string>>"
    )
    rows = documents.select("file", "target", F.explode(head_of(items, limit)).alias("m"))
    first = lambda *keys: F.coalesce(
        *[F.nullif(F.try_element_at("m", F.lit(k)), F.lit("")) for k in keys], F.lit(""))
    default = lambda c, d: F.when(c == "", d).otherwise(c)
    return rows.select(
        "file", F.lit("BindingDB").alias("source"),
        first("ligand_id", "ligand_name", "monomerid").alias("ligand_id"),
        first("smiles", "ligand_smiles", "canonical_smiles", "smile").alias("smiles"),
        first("ki", "ic50", "k_d", "affinity").alias("activity"),
        default(first("units", "unit"), "nM").alias("units"),
        default(first("measurement_type", "binding_type"), "Ki/IC50").alias("type"), "target",
    )


def scan_link_table(lines: DataFrame, key: str = "gene", limit: int | None = None) -> DataFrame:
    """(gene, pathway_count, pathways): distinct second fields in line order, the first ``limit`` when given."""
    fields = F.split("value", "\t")
    seen = (
        lines.where(F.size(fields) >= 2).select(key, "line_no", fields[1].alias("pathway"))
        .groupBy(key, "pathway").agg(F.min("line_no").alias("_at"))
    )
    places = value_ranks(seen, "_at", [key]).select(key, "_at", F.col("min_rank").alias("_k"))
    counts = seen.groupBy(key).agg(F.count(F.lit(1)).alias("pathway_count"))
    chosen = seen.join(places, [key, "_at"])
    chosen = chosen if limit is None else chosen.where(F.col("_k") <= limit)
    head = chosen.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "pathway"))), lambda s: s["pathway"]), ",")
        .alias("pathways")
    )
    return counts.join(head, key)


def scan_id_map(answers: DataFrame) -> DataFrame:
    """(gene, entrez, uniprot, ensembl) of the first hit whose query is the symbol.

    Identifiers may be nested or flat. ``answers(gene, json)`` holds a hit list.
    """
    hits = F.from_json("json", "array<map<string,string>>")
    own = F.filter(hits, lambda h: F.upper(F.coalesce(F.try_element_at(h, F.lit("query")), F.lit(""))) == F.col("gene"))
    get = lambda key: F.coalesce(F.try_element_at("_h", F.lit(key)), F.lit(""))
    nested = lambda key, *paths: F.when(
        F.startswith(get(key), F.lit("{")),
        F.coalesce(*[F.nullif(F.get_json_object(get(key), p), F.lit("")) for p in paths], F.lit("")),
    ).otherwise(get(key))
    return answers.withColumn("_h", F.try_element_at(own, F.lit(1))).select(
        "gene", get("entrezgene").alias("entrez"),
        nested("uniprot", "$['Swiss-Prot']", "$.SWISSPROT").alias("uniprot"),
        nested("ensembl", "$.gene").alias("ensembl"),
    )


def preferred_target(answers: DataFrame, organism: str = "homo sapiens") -> DataFrame:
    """(gene, chembl_target_id): first target of the organism, else the first target."""
    targets = F.from_json(
        F.get_json_object("json", "$.targets"), "array<struct<organism: string, target_chembl_id: string>>"
    )
    human = F.filter(targets, lambda t: F.lower(F.coalesce(t["organism"], F.lit(""))) == organism)
    pick = lambda a: F.nullif(F.try_element_at(a, F.lit(1))["target_chembl_id"], F.lit(""))
    return answers.select("gene", F.coalesce(pick(human), pick(targets), F.lit("")).alias("chembl_target_id"))


# ---- structures, logs, ligand lists ---------------------------------------------------------


def _atoms(lines: DataFrame) -> DataFrame:
    at = lambda start, length: F.trim(F.substring("value", start, length))
    return lines.select(
        "file", F.trim(F.substring("value", 1, 6)).alias("record"), at(18, 3).alias("resname"),
        F.substring("value", 22, 1).alias("chain"), at(23, 4).alias("resseq"),
        *[at(s, 8).try_cast("double").alias(c) for s, c in ((31, "x"), (39, "y"), (47, "z"))],
        F.startswith("value", F.lit("ATOM")).alias("is_atom"),
        F.startswith("value", F.lit("HETATM")).alias("is_hetero"),
    )


def scan_structure_box(lines: DataFrame) -> DataFrame:
    """Per file: box centre, size and mode. Hetero atoms without water win over the protein."""
    atoms = _atoms(lines).where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
    hetero = F.col("is_hetero") & ~F.col("resname").isin(*WATER_NAMES)
    used = atoms.where(hetero | F.col("is_atom")).withColumn("_het", hetero)
    sets = used.groupBy("file", "_het").agg(
        *[f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("mean", F.avg), ("lo", F.min), ("hi", F.max))]
    )
    stats = [f"{n}_{c}" for c in "xyz" for n in ("mean", "lo", "hi")]
    best = sets.groupBy("file").agg(F.max(F.struct("_het", *stats)).alias("_b"))
    span = lambda c: F.when(
        F.col("_b._het"),
        F.round(F.greatest(F.lit(18.0), F.ceil(F.col(f"_b.hi_{c}") - F.col(f"_b.lo_{c}")) + 6.0) * 2) / 2,
    ).otherwise(30.0)
    boxes = best.select(
        "file", *[F.round(F.col(f"_b.mean_{c}"), 2).alias(f"center_{c}") for c in "xyz"],
        *[span(c).alias(f"size_{c}") for c in "xyz"],
        F.when(F.col("_b._het"), "cocrystal_ligand").otherwise("protein_centroid").alias("mode"),
    )
    return boxes.withColumn("valid", valid_box())


def valid_box() -> Column:
    """Whether all centre and size values are finite and the sizes positive."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    out = F.lit(True)
    for axis in "xyz":
        out = out & finite(f"center_{axis}") & finite(f"size_{axis}") & (F.col(f"size_{axis}") > 0)
    return yes(out)


def scan_hetero_groups(lines: DataFrame, fewest: int = 3) -> DataFrame:
    """(file, chain, resseq, resname, atoms): bound molecules other than water and ions."""
    return (
        _atoms(lines).where(F.col("is_hetero") & ~F.col("resname").isin(*ION_NAMES))
        .groupBy("file", "chain", "resseq", "resname").agg(F.count(F.lit(1)).alias("atoms"))
        .where(F.col("atoms") >= fewest)
    )


def scan_affinity_log(lines: DataFrame) -> DataFrame:
    """(file, line_no, mode, affinity, rmsd_lb, rmsd_ub): rows of the affinity tables in engine logs."""
    parts = F.split(F.trim("value"), r"\s+")
    field = lambda i: F.try_element_at(parts, F.lit(i))
    both = number(field(3)).isNotNull() & number(field(4)).isNotNull()
    return lines.where(field(1).rlike(r"^\d+$") & number(field(2)).isNotNull()).select(
        "file", "line_no", field(1).cast("int").alias("mode"), number(field(2)).alias("affinity"),
        F.when(both, number(field(3))).alias("rmsd_lb"), F.when(both, number(field(4))).alias("rmsd_ub"),
    )


def best_mode(modes: DataFrame) -> DataFrame:
    """Strongest mode per file (first line on ties)."""
    best = F.min(F.struct("affinity", "line_no", "mode", "rmsd_lb", "rmsd_ub")).alias("_b")
    return modes.groupBy("file").agg(best).select(
        "file", "_b.mode", "_b.affinity", "_b.rmsd_lb", "_b.rmsd_ub"
    )


def scan_smiles_list(lines: DataFrame) -> DataFrame:
    """(file, index, id, smiles): blank lines and # comments skipped, ids default to mol_N."""
    text = F.trim("value")
    parts = F.split(text, r"\s+")
    default = F.concat(F.lit("mol_"), F.col("line_no").cast("string"))
    return lines.where((text != "") & ~F.startswith(text, F.lit("#"))).select(
        "file", F.col("line_no").alias("index"),
        safe_name(F.try_element_at(parts, F.lit(2)), default).alias("id"), parts[0].alias("smiles"),
    )


# ---- cohorts, listings, metadata ------------------------------------------------------------


def cohort_matrix(records: DataFrame, id_map: DataFrame, types: DataFrame) -> DataFrame:
    """(gene, sample, value, condition) from (entrez, sample, value), (entrez, gene), (sample, type).

    Only numeric values of samples with a known type; repeated records keep the largest value.
    """
    named = records.select("entrez", "sample", number(F.col("value").cast("string")).alias("value")).where(
        F.col("value").isNotNull()
    )
    condition = F.when(F.lower("type").contains("normal"), "Normal").otherwise("Tumor")
    return (
        named.join(id_map, "entrez").join(types.select("sample", condition.alias("condition")), "sample")
        .groupBy("gene", "sample", "condition").agg(F.max("value").alias("value"))
    )


def patient_of(sample: Column) -> Column:
    """Patient id: the sample id without its last dash part when it has at least two dashes."""
    dashes = F.size(F.split(sample, "-")) - 1
    return F.when(dashes >= 2, F.regexp_replace(sample, r"-[^-]+$", "")).otherwise(sample)


def clinical_join(samples: DataFrame, attributes: DataFrame) -> DataFrame:
    """Samples with the survival of their patient, from (patient, attribute, value) rows."""
    pick = lambda name: F.max(F.when(F.col("attribute") == name, F.col("value")))
    status = F.upper(F.trim("_status"))
    patients = attributes.groupBy("patient").agg(
        pick("OS_MONTHS").alias("_months"), pick("OS_STATUS").alias("_status")
    ).where("_months IS NOT NULL AND _status IS NOT NULL").select(
        "patient", number("_months").alias("os_months"),
        F.when(status.startswith("1") | status.startswith("D"), 1.0).otherwise(0.0).alias("os_status"),
    )
    return samples.withColumn("patient", patient_of(F.col("sample"))).join(patients, "patient", "left")


def study_rank(types: DataFrame, attributes: DataFrame) -> DataFrame:
    """(study, normals, rank_key): normal samples per study, only studies with survival data."""
    normal = types.groupBy("study").agg(F.count_if(F.lower("type").contains("normal")).alias("normals"))
    survived = attributes.groupBy("study").agg(
        F.bool_or(F.col("attribute") == "OS_MONTHS").alias("_os")
    ).where("_os").select("study")
    return survived.join(normal, "study", "left").select("study", F.coalesce("normals", F.lit(0)).alias("normals"))


def file_role(name: Column) -> Column:
    """matrix / barcodes / genes / metadata / skip from a file name."""
    low = F.lower(name)
    skipped = low.rlike(ARCHIVE_FILES) | low.rlike("|".join(SKIPPED_TOKENS))
    matrix = low.rlike(MATRIX_FILES) | name.rlike(BULK_COUNT_FILES)
    return (
        F.when(skipped, "skip").when(low.rlike(METADATA_FILES), "metadata")
        .when(low.contains("barcode"), "barcodes")
        .when(low.contains("genes") | low.contains("features"), "genes")
        .when(matrix, "matrix").otherwise("skip")
    )


def classify_files(files: DataFrame) -> DataFrame:
    """(dataset, mode, role counts) from a listing (dataset, name) of many datasets."""
    role = F.col("role")
    matrix = role == "matrix"
    low = F.lower("name")
    facts = files.withColumn("role", file_role(F.col("name"))).groupBy("dataset").agg(
        F.count_if(matrix).alias("matrices"), F.count_if(role == "barcodes").alias("barcodes"),
        F.count_if(role == "genes").alias("genes"), F.count_if(role == "metadata").alias("metadata"),
        F.bool_or(matrix & F.col("name").rlike(BULK_COUNT_FILES)).alias("_bulk"),
        F.bool_or(matrix & low.rlike(CONTAINER_FILES)).alias("_container"),
        F.bool_or(matrix & F.col("name").rlike(SINGLE_CELL_FILES)).alias("_cells"),
    )
    lists = (F.col("barcodes") > 0) | (F.col("genes") > 0)
    plain = (F.col("matrices") > 0) & ~lists & ~F.col("_cells")
    bulk = F.col("_bulk") | (~F.col("_container") & plain)
    single = F.col("_container") | lists | F.col("_cells")
    return facts.select(
        "dataset", "matrices", "barcodes", "genes", "metadata",
        F.when(bulk, "bulk").when(single, "single_cell").otherwise("generic").alias("mode"),
    )


# Column names that hold the condition.
CONDITION_ALIASES = (
    "condition", "group", "disease", "disease_status", "health_status", "histology", "cancer_type",
    "cancer.type", "tissue", "site", "tissue_sub", "sample_type", "status", "treatment",
)


def infer_condition(cells: DataFrame, annotations: DataFrame | None = None) -> DataFrame:
    """Add ``condition`` from the first alias column with two values, else from the sample table."""
    candidates = [c for c in cells.columns if c.lower() in CONDITION_ALIASES]
    if candidates:
        counts = cells.agg(*[
            (F.min(f"`{c}`") < F.max(f"`{c}`")).alias(str(i)) for i, c in enumerate(candidates)
        ]).first()
        for i, c in enumerate(candidates):
            if counts[i]:
                return cells.withColumn("condition", F.col(f"`{c}`").cast("string"))
    if annotations is not None:
        others = [c for c in annotations.columns if c.lower() != "sample"]
        counts = annotations.agg(*[
            (F.min(f"`{c}`") < F.max(f"`{c}`")).alias(str(i)) for i, c in enumerate(others)
        ]).first()
        for i, c in enumerate(others):
            if counts[i]:
                side = annotations.groupBy("sample").agg(F.min(f"`{c}`").cast("string").alias("condition"))
                return cells.drop("condition").join(side, "sample", "left")
    return cells.withColumn("condition", F.lit(None).cast("string"))


def gene_id_normalize(genes: DataFrame, id_table: DataFrame, species: str = "hs") -> DataFrame:
    """(gene, entrez) by symbol or Ensembl id; mouse symbols are also tried with a capital only.

    ``id_table(symbol, ensembl, entrez)``.
    """
    ensembl = F.col("gene").rlike(r"^ENS(?:MUS)?G\d+")
    spellings = F.array("gene", F.initcap(F.lower("gene"))) if species == "mm" else F.array("gene")
    keyed = genes.select("gene").distinct().select(
        "gene", F.when(ensembl, "ensembl").otherwise("symbol").alias("kind"),
        F.explode(F.array_distinct(spellings)).alias("id"),
    )
    ids = id_table.select("entrez", F.explode(F.array(
        F.struct(F.lit("symbol").alias("kind"), F.col("symbol").alias("id")),
        F.struct(F.lit("ensembl").alias("kind"), F.col("ensembl").alias("id")),
    )).alias("k")).select("entrez", "k.kind", "k.id").where("id IS NOT NULL")
    return keyed.join(ids, ["kind", "id"]).select("gene", "entrez").distinct()


def _barcode_keys(c: Column, s: Column | None) -> list[tuple[Column, str]]:
    """Key of a cell for each matching strategy, with the name of the key on the other side."""
    stem = F.regexp_replace(c, r"_[^_]+$", "")
    keys = [(c, "plain")]
    if s is not None:
        rest = F.when(F.startswith(c, s), F.replace(c, F.concat(s, F.lit("_")), F.lit(""))).when(
            F.endswith(c, s), F.replace(c, F.concat(F.lit("_"), s), F.lit(""))).otherwise(c)
        keys.append((F.when(s.isNotNull(), F.concat_ws("_", s, rest)), "plain"))
    affix = F.when(stem != c, stem).otherwise(F.regexp_replace(c, r"^[^_]+_", ""))
    keys += [
        (affix, "affix"), (stem, "plain"), (F.replace(stem, F.lit("."), F.lit("-")), "dots"),
        (F.replace(c, F.lit("."), F.lit("-")), "dots"), (F.regexp_replace(c, r"^.*_", ""), "tail"),
        (F.regexp_replace(c, r"-\d+$", ""), "number"), (F.regexp_replace(stem, r"-.*$", ""), "head"),
        (stem, "tail"),
    ]
    return keys


def barcode_match_join(cells: DataFrame, metadata: DataFrame, enough: int = 10) -> DataFrame:
    """(cell, barcode, strategy): the first normalisation that matches at least ``enough`` cells.

    All strategies are tried in one join on (kind of key, key); repeated keys on the metadata side
    keep their first barcode. Without a good strategy the last one counts. The keys are six rows per
    barcode, which size estimates do not see, so the join is told to sort both sides; what it finds
    is written once.
    """
    s = F.col("sample") if "sample" in cells.columns else None
    wanted = cells.select("cell", F.posexplode(F.array(*[
        F.struct(k.alias("key"), F.lit(side).alias("side")) for k, side in _barcode_keys(F.col("cell"), s)
    ])).alias("strategy", "k")).select("cell", "strategy", "k.key", "k.side")
    v = F.col("barcode")
    stem = F.regexp_replace(v, r"_[^_]+$", "")
    sides = {
        "plain": v, "affix": F.when(stem != v, stem).otherwise(F.regexp_replace(v, r"^[^_]+_", "")),
        "dots": F.replace(v, F.lit("."), F.lit("-")), "tail": F.regexp_replace(v, r"^.*_", ""),
        "number": F.regexp_replace(v, r"-\d+$", ""), "head": F.regexp_replace(v, r"-.*$", ""),
    }
    known = metadata.select("barcode", F.explode(F.array(*[
        F.struct(F.lit(n).alias("side"), c.alias("key")) for n, c in sides.items()
    ])).alias("k")).groupBy("k.side", "k.key").agg(F.min("barcode").alias("barcode"))
    matched = cut_lineage(wanted.join(known.hint("merge"), ["side", "key"]).select("cell", "barcode", "strategy"))
    counts = matched.groupBy("strategy").agg(F.count(F.lit(1)).alias("n"))
    chosen = counts.agg(F.coalesce(
        F.min(F.when(F.col("n") >= enough, F.col("strategy"))), F.max("strategy"))).scalar()
    return matched.where(F.col("strategy") == chosen)
