"""Readers: literal-safe CSV, JSON lines, Parquet, wrapped JSON, listings, JDBC, and a paginated source."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.contracts import ContractError

# Names under which wrapped JSON keeps its rows.
WRAPPERS = ("records", "trialSpaces", "trial_spaces", "data")


def read_clinical_csv(spark: SparkSession, path: str | Sequence[str], schema: str | None = None, separator: str = ",", encoding: str = "UTF-8", one_line: bool = False) -> DataFrame:
    """CSV whose text stays as it is: None, NA, N/A, null and NaN are text, only an empty cell is null.

    Quoted cells may hold line ends; one_line: none does, so a large file is read in splits. Without a
    schema all columns are text.
    """
    reader = spark.read.option("header", True).option("multiLine", not one_line).option("quote", '"').option("escape", '"').option("sep", separator).option("encoding", encoding).option("nullValue", "").option("emptyValue", "").option("nanValue", "\x00").option("inferSchema", False)
    frame = (reader.schema(schema) if schema else reader).csv(path if isinstance(path, str) else list(path))
    texts = {n for n, kind in frame.dtypes if kind == "string"}
    return frame.select(*(F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if c in texts else F.col(f"`{c}`") for c in frame.columns))


def read_table(spark: SparkSession, path: str, wanted: Sequence[str] | None = None, schema: str | None = None) -> DataFrame:
    """Parquet, JSON lines (also gzipped) or CSV by the path's ending; of ``wanted`` the columns that exist."""
    name = path.rstrip("/").removesuffix(".gz")
    if name.endswith(".parquet"):
        frame = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    elif name.endswith((".jsonl", ".ndjson", ".json")):
        frame = (spark.read.schema(schema) if schema else spark.read).json(path)
    elif name.endswith((".csv", ".tsv", ".psv")):
        frame = read_clinical_csv(spark, path, schema, {"csv": ",", "tsv": "\t", "psv": "|"}[name.rsplit(".", 1)[1]])
    else:
        raise ContractError(f"no reader for {path}")
    return frame if wanted is None else frame.select(*(c for c in wanted if c in frame.columns))


def read_many(spark: SparkSession, paths: Sequence[str], dedupe: Sequence[str] | None = None) -> DataFrame:
    """All files or globs, each once, with the columns of any of them; rows that repeat the ``dedupe`` columns once."""
    frames = [read_table(spark, p) for p in dict.fromkeys(paths)]
    if not frames:
        raise ContractError("no inputs")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    if not dedupe:
        return out
    others = [c for c in out.columns if c not in dedupe]
    return out.groupBy(*dedupe).agg(F.min(F.struct(*others)).alias("__row")).select(*dedupe, "__row.*") if others else out.distinct()


def read_wrapped_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files that are an array of rows, or an object that keeps them under one of ``WRAPPERS``."""
    texts = spark.read.text(path, wholetext=True).select(F.col("value").alias("v"))
    rows = F.coalesce(*(F.from_json(F.get_json_object("v", f"$.{w}"), f"array<struct<{schema}>>") for w in WRAPPERS), F.from_json("v", f"array<struct<{schema}>>"))
    return texts.select(F.inline(rows))


def read_rows_by_key(frame: DataFrame, key: str, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Wide rows of wanted keys: the keys are few, so they are joined before the wide columns are read."""
    return frame.select(key, *columns).join(wanted.select(key).distinct(), key, "left_semi")


def read_database(spark: SparkSession, url: str, tables: Sequence[str] | None = None, options: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Tables of a JDBC database by name; without names all base tables of its information schema."""
    def load(table: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {})).load()

    if tables is None:
        found = load("(SELECT table_schema, table_name FROM information_schema.tables WHERE table_type = 'BASE TABLE') t")
        tables = [f"{r[0]}.{r[1]}" for r in found.orderBy("table_schema", "table_name").toLocalIterator() if r[0] not in ("pg_catalog", "information_schema")]
    return {t: load(t) for t in tables}


def cached_columns(spark: SparkSession, path: str, columns: Sequence[str], cache: str) -> DataFrame:
    """Some columns of a table, kept in the folder ``cache`` as long as the table's size and time stay the same."""
    import hashlib

    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files, facts = fs.listFiles(root, True), []
    while files.hasNext():
        status = files.next()
        facts.append((status.getPath().getName(), status.getLen(), status.getModificationTime()))
    key = hashlib.sha256(repr((path, sorted(columns), sorted(facts))).encode()).hexdigest()[:24]
    kept = f"{cache.rstrip('/')}/{key}.parquet"
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(kept)):
        from .writers import publish

        publish(read_table(spark, path, columns), kept)
    return spark.read.parquet(kept)


def block_sample(spark: SparkSession, path: str, fraction: float, *seed) -> DataFrame:
    """Rows of whole blocks (splits) of a Parquet or text table's files: a block is drawn by a hash of its file and start.

    With ``block_file`` and ``block_start``. Blocks that aren't drawn are skipped by the scan's own rows, so a
    sample costs their reading at most once; set ``spark.sql.files.maxPartitionBytes`` for the block size.
    """
    from ..functions.hashing import hash_fraction

    rows = read_table(spark, path).select("*", F.col("_metadata.file_name").alias("block_file"), F.col("_metadata.file_block_start").alias("block_start"))
    return rows.where(hash_fraction(*seed, F.col("block_file"), F.col("block_start")) < fraction)


DATE_FIELDS = {"study_start": "startDateStruct", "primary_completion": "primaryCompletionDateStruct", "completion": "completionDateStruct", "study_first_post": "studyFirstPostDateStruct", "last_update_post": "lastUpdatePostDateStruct"}

_DATED = ", ".join(f"{f}: struct<date: string, type: string>" for f in DATE_FIELDS.values())
LISTING_SCHEMA = f"""protocolSection struct<
  identificationModule: struct<nctId: string, briefTitle: string, officialTitle: string>,
  statusModule: struct<overallStatus: string, statusVerifiedDate: string, {_DATED}>,
  designModule: struct<studyType: string, phases: array<string>>,
  descriptionModule: struct<briefSummary: string>,
  conditionsModule: struct<conditions: array<string>>,
  eligibilityModule: struct<eligibilityCriteria: string, sex: string, minimumAge: string, maximumAge: string>>"""


def _text(path: str) -> Column:
    return F.coalesce(F.col(f"protocolSection.{path}"), F.lit(""))


def flatten_listings(nested: DataFrame) -> DataFrame:
    """One flat row a listing: missing text is empty, phases stay an array; records without an id are left out."""
    dated = [F.coalesce(F.col(f"protocolSection.statusModule.{field}.{part}"), F.lit("")).alias(f"{name}_date{'' if part == 'date' else '_type'}") for name, field in DATE_FIELDS.items() for part in ("date", "type")]
    title, summary, criteria = _text("identificationModule.briefTitle"), _text("descriptionModule.briefSummary"), _text("eligibilityModule.eligibilityCriteria")
    return nested.where("protocolSection.identificationModule.nctId IS NOT NULL").select(
        F.col("protocolSection.identificationModule.nctId").alias("nct_id"),
        _text("designModule.studyType").alias("study_type"),
        F.coalesce(F.col("protocolSection.designModule.phases"), F.array().cast("array<string>")).alias("phases"),
        _text("statusModule.overallStatus").alias("overall_status"),
        _text("statusModule.statusVerifiedDate").alias("status_verified_date"),
        *dated,
        title.alias("title"),
        summary.alias("brief_summary"),
        criteria.alias("eligibility_criteria"),
        F.coalesce(F.col("protocolSection.conditionsModule.conditions"), F.array().cast("array<string>")).alias("conditions"),
        _text("eligibilityModule.sex").alias("sex"),
        _text("eligibilityModule.minimumAge").alias("minimum_age"),
        _text("eligibilityModule.maximumAge").alias("maximum_age"),
        F.concat_ws("\n", F.nullif(title, F.lit("")), F.nullif(summary, F.lit("")), F.nullif(criteria, F.lit(""))).alias("trial_text"),
    )


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listings from JSON exports (arrays or lines); records that can't be read are skipped."""
    nested = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").schema(LISTING_SCHEMA).json(path)
    return flatten_listings(nested)


def read_pages(fetch: Callable[[str | None], dict], rows: str = "studies", token: str = "nextPageToken") -> Iterator[dict]:
    """Rows of a paginated service; a token that comes twice is an error."""
    seen, at = set(), None
    while True:
        page = fetch(at)
        yield from page.get(rows, ())
        at = page.get(token)
        if at is None:
            return
        if at in seen:
            raise ContractError(f"the page token {at} came twice")
        seen.add(at)


class _Batch(InputPartition):
    def __init__(self, ids: list[str]):
        self.ids = ids


class ListingSource(DataSource):
    """Spark source ``listings``: records as JSON text, by ids in batches of 100 or all pages.

    Options: ``url`` (http(s) service, or a file:// folder of saved pages for tests) and ``ids``
    (comma-separated). Each batch of ids is a partition; pages follow each other in one.
    """

    @classmethod
    def name(cls) -> str:
        return "listings"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> DataSourceReader:
        return _ListingReader(dict(self.options))


class _ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        ids = list(dict.fromkeys(i.strip() for i in self.options.get("ids", "").split(",") if i.strip()))
        return [_Batch(ids[i : i + 100]) for i in range(0, len(ids), 100)] or [_Batch([])]

    def read(self, partition: _Batch) -> Iterator[tuple[str]]:
        from urllib.parse import urlencode
        from urllib.request import urlopen

        url = self.options["url"]

        def fetch(token: str | None) -> dict:
            if url.startswith("file://"):
                address = f"{url.rstrip('/')}/{token or 'first'}.json"
            else:
                query = {"format": "json", "pageSize": 100} | ({"filter.ids": "|".join(partition.ids)} if partition.ids else {}) | ({"pageToken": token} if token else {})
                address = f"{url}?{urlencode(query)}"
            with urlopen(address, timeout=60) as answer:  # noqa: S310
                return json.load(answer)

        wanted = set(partition.ids)
        for record in read_pages(fetch):
            found = record.get("protocolSection", {}).get("identificationModule", {}).get("nctId")
            if not wanted or found in wanted:
                yield (json.dumps(record),)


def missing_ids(records: DataFrame, ids: Sequence[str]) -> list[str]:
    """Ids that were asked for and not found."""
    found = {r[0] for r in records.select(F.get_json_object("record", "$.protocolSection.identificationModule.nctId")).distinct().collect()}  # as many as were asked for
    return [i for i in dict.fromkeys(ids) if i not in found]
