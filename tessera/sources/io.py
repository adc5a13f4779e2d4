"""Text and Parquet sources and sinks, and the checks of what was written."""

from __future__ import annotations

import json
import os
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RAW_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
STORE_COLUMNS = ["num", "src", "country", "name_core", "name_skel", "name_nospace", "legal", "addr_alpha", "addr_digits", "postal", "house"]
#: (split, source) -> file name.
SOURCE_FILES = {(split, src): f"{split}_source{src}.tsv" for split in ("train", "test") for src in (1, 2, 3)}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with invalid UTF-8 replaced and a carriage return at the end removed; column value."""
    return spark.read.text(path, lineSep="\n").select(F.regexp_replace(F.make_valid_utf8("value"), "\r$", "").alias("value"))


def read_records(spark: SparkSession, path: str, src: int) -> DataFrame:
    """id, num, src, country, business_name, business_address of a TSV; header, short and malformed rows are left out.

    The written id is kept as it is, so zero padding survives.
    """
    parts = read_lines(spark, path).select(F.split("value", "\t", -1).alias("f")).where(F.size("f") >= 4)
    num = F.expr("try_cast(substring(f[0], 4) AS bigint)")
    rows = parts.select(F.col("f")[0].alias("id"), num.alias("num"), F.lit(src).cast("int").alias("src"), F.col("f")[3].alias("country"), F.col("f")[1].alias("business_name"), F.col("f")[2].alias("business_address"))
    return rows.where("num IS NOT NULL AND id <> 'entity_id'")


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines without the header, and those that read_records leaves out."""
    lines = read_lines(spark, path).where("value NOT LIKE 'entity_id%'").select(F.split("value", "\t", -1).alias("f"))
    bad = (F.size("f") < 4) | F.expr("try_cast(substring(f[0], 4) AS bigint) IS NULL")
    return lines.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("malformed"))


def read_sources(spark: SparkSession, folder: str, split: str) -> DataFrame:
    out = None
    for (s, src), name in SOURCE_FILES.items():
        if s == split:
            part = read_records(spark, f"{folder}/{name}", src)
            out = part if out is None else out.unionByName(part)
    return out


def read_id_lists(spark: SparkSession, path: str) -> DataFrame:
    """q_id, ids (array, empty where nothing is listed), has_tab, line."""
    parts = read_lines(spark, path).withColumn("line", F.monotonically_increasing_id()).where("trim(value) <> ''")
    f = F.split("value", "\t", -1)
    rows = parts.select("line", F.trim(f[0]).alias("q_id"), (F.size(f) > 1).alias("has_tab"), F.coalesce(F.get(f, 1), F.lit("")).alias("list"))
    ids = F.filter(F.transform(F.split("list", ","), lambda x: F.trim(x)), lambda x: x != "")
    return rows.where("q_id <> 'source1_entity_id'").select("q_id", ids.alias("ids"), "has_tab", "line")


def read_ground_truth(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """(q_id, c_id) links; of the wanted entities only, if given."""
    lists = read_id_lists(spark, path)
    if wanted is not None:
        lists = lists.join(wanted.select("q_id"), "q_id", "left_semi")
    return lists.select("q_id", F.explode("ids").alias("c_id"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """First column of a file in its order: id, line; blank lines left out."""
    rows = read_lines(spark, path).withColumn("line", F.monotonically_increasing_id())
    return rows.select(F.trim(F.split("value", "\t")[0]).alias("id"), "line").where("id <> '' AND id <> 'entity_id'")


def store_rows(store: DataFrame) -> DataFrame:
    """The normalised views as the eleven flat columns of the record store; arrays joined, null as ''."""
    flat = {"name_core": F.array_join("core", " "), "legal": F.array_join("legal", ","), "addr_alpha": F.array_join("addr_alpha", " "), "addr_digits": F.array_join("addr_digits", ",")}
    return store.select(*[flat.get(c, F.col(c)).alias(c) for c in STORE_COLUMNS])


def write_store(store: DataFrame, path: str, exist_ok: bool = False) -> None:
    """Parquet by source and country; an existing store stops it unless exist_ok, and so does a result without rows."""
    rows = store_rows(store)
    rows.write.mode("overwrite" if exist_ok else "errorifexists").option("compression", "zstd").partitionBy("src", "country").parquet(path)
    if store.sparkSession.read.schema(rows.schema).parquet(path).isEmpty():
        raise ValueError(f"0 rows written to {path}")


def read_store(spark: SparkSession, path: str, columns: list[str] | None = None, country: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df if country is None else df.where(F.col("country") == country)
    return df.select(*(columns or STORE_COLUMNS))


def submission_rows(required: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every required entity once: q_id and matched, the distinct ids of sources 2 and 3 joined by commas, '' for none."""
    ids = predictions.where(F.col("c_id").rlike("^S[23]-")).groupBy("q_id").agg(F.array_sort(F.collect_set("c_id")).alias("ids"))
    return required.join(ids, "q_id", "left").select("q_id", F.coalesce(F.array_join("ids", ","), F.lit("")).alias("matched"))


def write_submission(rows: DataFrame, path: str, header: str = "source1_entity_id\tmatched_entity_ids") -> None:
    """One text file: the header, then a line an entity in the order of ids."""
    spark = rows.sparkSession
    head = spark.createDataFrame([(header, 0, "")], "value string, part int, q_id string")
    lines = rows.select(F.concat_ws("\t", "q_id", "matched").alias("value"), F.lit(1).alias("part"), "q_id")
    head.unionByName(lines).orderBy("part", "q_id").coalesce(1).select("value").write.mode("overwrite").text(path)


def validate_lists(required: DataFrame, lists: DataFrame, known: DataFrame) -> DataFrame:
    """One row of counts: missing, unknown and repeated entities, repeated ids, self matches, bad prefixes, unknown ids, empty lists."""
    names = lists.groupBy("q_id").agg(F.count(F.lit(1)).alias("n"))
    ids = lists.select("q_id", F.explode("ids").alias("c_id"))
    counts = [
        required.join(names, "q_id", "left_anti").agg(F.count(F.lit(1)).alias("missing_entities")),
        names.join(required, "q_id", "left_anti").agg(F.count(F.lit(1)).alias("unknown_entities")),
        names.agg(F.count_if(F.col("n") > 1).alias("repeated_entities")),
        lists.agg(F.count_if(F.size(F.array_distinct("ids")) < F.size("ids")).alias("lists_with_repeats"), F.count_if(F.size("ids") == 0).alias("empty_lists")),
        ids.agg(F.count_if(F.col("q_id") == F.col("c_id")).alias("self_matches"), F.count_if(~F.col("c_id").rlike("^S[23]-")).alias("bad_prefixes")),
        ids.join(known.select(F.col("id").alias("c_id")), "c_id", "left_anti").agg(F.count(F.lit(1)).alias("unknown_ids")),
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.join(one)
    return out


def matches_outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """q_id, outside: matched ids that the entity's candidates (q_id, ids) lack, for entities that have such."""
    own = candidates.select("q_id", F.explode("ids").alias("c_id")).distinct()
    lost = matches.select("q_id", F.explode("ids").alias("c_id")).distinct().join(own, ["q_id", "c_id"], "left_anti")
    return lost.groupBy("q_id").agg(F.array_sort(F.collect_list("c_id")).alias("outside"))


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet store; no column is read, the counts come from the footers."""
    return spark.read.option("aggregatePushdown", "true").parquet(path).count()


def head(spark: SparkSession, path: str, lines: int = 11) -> list[str]:
    """The first lines of a text file."""
    return [r.value for r in read_lines(spark, path).limit(lines).collect()]


def sample_entities(entities: DataFrame, most: int, by: str | None = None, id_col: str = "q_id", seed: int = 7) -> DataFrame:
    """`most` entities, of each value of `by` if given: those whose hashed ids come first, so any partitioning gives the same."""
    hashed = entities.withColumn("_h", F.xxhash64(F.lit(seed), F.col(id_col)))
    if by is None:
        return hashed.orderBy("_h", id_col).limit(most).drop("_h")
    first = Window.partitionBy(by).orderBy("_h", id_col)
    return hashed.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most).drop("_h", "_n")


def repair_candidates(candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """candidates (q_id, ids) with the matched ids that they lack appended."""
    joined = candidates.join(matches.select("q_id", F.col("ids").alias("m")), "q_id", "left")
    return joined.select("q_id", F.concat("ids", F.array_except(F.coalesce("m", F.array().cast("array<string>")), "ids")).alias("ids"))


def find_dataset(root: str, names: list[str], least: int = 1024) -> dict[str, str]:
    """Largest real file of each name under root: no `._` sidecars, no `__MACOSX`, nothing up to `least` bytes."""
    found: dict[str, str] = {}
    for name in names:
        hits = [p for p in Path(root).rglob(name) if p.is_file() and not p.name.startswith("._") and "__MACOSX" not in p.parts and p.stat().st_size > least]
        if hits:
            found[name] = str(max(hits, key=lambda p: p.stat().st_size))
    return found


def folders(root: str) -> dict[str, str]:
    """Data, artifact and output folders: environment variables first, then folders of root."""
    return {kind: os.environ.get(f"TESSERA_{kind.upper()}_DIR", str(Path(root) / kind)) for kind in ("dataset", "artifacts", "output")}


def write_json(path: str, value: dict) -> None:
    draft = f"{path}.tmp"
    Path(draft).write_text(json.dumps(value, indent=1, sort_keys=True))
    os.replace(draft, path)


def runs(root: str) -> list[dict]:
    """metrics.json of every run folder, newest first."""
    found = [p for p in Path(root).glob("*/metrics.json")]
    return [{"run": p.parent.name} | json.loads(p.read_text()) for p in sorted(found, key=lambda p: -p.stat().st_mtime)]


def package(out: str, files: list[str], report: dict) -> None:
    """A zip of the files; refused if the validation report counts anything wrong."""
    wrong = {k: v for k, v in report.items() if v and k != "empty_lists"}
    if wrong:
        raise ValueError(f"validation failed: {wrong}")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in files:
            z.write(f, Path(f).name)
