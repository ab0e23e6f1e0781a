"""The hotel master: drop, bronze, silver, gold, CSV."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from masterloom.context import RunContext
from masterloom.functions import (
    code_field,
    concat_phone_parts,
    fill_blank,
    full_address,
    hhmm_time,
    initial_flag,
    last_digits,
    reference_fallback,
    standardize_property_codes,
)
from masterloom.operators import (
    Reference,
    add_audit,
    apply_mapping,
    attach,
    changed_keys,
    enrich_reference,
    fits_broadcast,
    lookup_join,
    reject_blank_keys,
    sanitize_columns,
    schema_drift,
    spread,
    standardize_phones,
    string_schema,
    with_dial_plan,
    with_row_hash,
)
from masterloom.plans import hotel_spec as spec
from masterloom.sources import (
    Load,
    NewestFile,
    RunLedger,
    any_known,
    append_evolving,
    batch_slice,
    drop_partition,
    ensure_table,
    export_csv,
    file_stamps,
    footer_stamps,
    keep_newest,
    many_partitions,
    merge_table,
    of_keys,
    read_drop,
    read_evolved,
    replace_partition,
    rows_of_keys,
    staged,
    utc_text,
    widen_table,
)
from masterloom.sources.drops import EPOCH
from masterloom.sources.ledger import micros
from masterloom.sources.tables import RANGE_COLUMN

TIMESTAMP = "lastmodifieddate"
# Wide rows are worked on by single operators where their common method would not be compiled.
SMALL_METHODS = ("spark.sql.codegen.hugeMethodLimit", "8000")
# A run reads its wide rows from files; there the common method, which calls one of each operator, is compiled.
COMMON_METHODS = ("spark.sql.codegen.hugeMethodLimit", "65535")
# Pairs of a brand and a country that are broadcast with their lookups' columns.
MAX_BROADCAST_PAIRS = 50_000
SILVER_AUDIT = ("createdby", "lastupdatedby", "createdtimestamp", "lastupdatedtimestamp")
#: What a load goes through; a brand load ends with bronze.
STAGES = ("found", "bronze", "silver planned", "silver", "gold planned", "gold", "exported")
#: The column of silver and gold that has a hash of what this job writes of a row, where a table has one.
ROW_HASH = "row_hash"
CHANGES = StructType([StructField(c, StringType()) for c in ("Code", "load", "layer")])


@dataclass(frozen=True)
class HotelTables:
    """Table names, and how new ones are laid out."""

    bronze_hotel: str
    bronze_brand: str
    silver: str
    gold: str
    # All columns, in order, of a gold table that does not exist yet: the wide table
    # is shared, and most of its columns belong to other sources.  Without a list it
    # gets the columns this job writes.
    gold_columns: Sequence[str] = ()
    # Hash buckets by key of new silver and gold tables; 0 for none.
    buckets: int = 0
    # Or partitions by key range, of which an upsert reads and writes only its own; 0 for none.
    ranges: int = 0
    # Give new silver and gold tables a hash of each row, so that ``only_if_changed`` reads
    # keys and hashes instead of all columns.
    row_hash: bool = False
    # What each load has reached, which keys it changes, which rows it could not take, and
    # the newest row of each brand; beside the silver table where no names are given.
    ledger: str = ""
    changes: str = ""
    rejected: str = ""
    brands: str = ""

    def named(self, role: str) -> str:
        return getattr(self, role) or f"{self.silver}_{role}"


@dataclass
class RunSummary:
    """What a run did."""

    status: str
    hotel_file: str | None = None
    brand_file: str | None = None
    loads: list[str] = field(default_factory=list)
    hotels: int = 0
    rejected: int = 0
    drift: dict[str, list[str]] = field(default_factory=dict)
    exports: list[str] = field(default_factory=list)


def silver_batch(
    hotels: DataFrame,
    brands: DataFrame,
    country_ref: DataFrame,
    brand_ref: DataFrame,
    dial_plan: DataFrame,
    code_mode: str = "strip",
    broadcast: bool | None = None,
    foreign: bool = False,
) -> DataFrame:
    """The silver rows of one load of hotels, without audit columns.

    ``brands`` may hold the whole brand history; the newest name of an id counts.
    All joins are left joins against one row per key, so each hotel stays one row.
    """
    if broadcast is None:
        sides = (brands.select("id", "name"), country_ref, brand_ref, dial_plan)
        # Where one is too large as it stands, each join measures its reduced side.
        broadcast = all(fits_broadcast(*sides)) or None
    enriched = _with_lookups(hotels, brands, country_ref, brand_ref, dial_plan, broadcast)
    keyed = enriched.withColumns(
        {
            "Code": code_field("id", spec.CODE_PREFIX),
            "phone": concat_phone_parts(*spec.PHONE_PARTS[1:], country=spec.PHONE_PARTS[0]),
            **{f"{b}_standardized": reference_fallback(a, b) for a, b in spec.FALLBACKS.items()},
        }
    )
    phoned = standardize_phones(
        keyed, spec.PHONES, "iso2char", dial_plan, drop_raw=True, broadcast=broadcast, foreign=foreign
    )
    coded = standardize_property_codes(phoned, spec.PROPERTY_CODES, mode=code_mode)
    standardized = coded.withColumns(
        {
            "sixdigitphonenumber": last_digits("formattedphone"),
            "StreetAddressFullAddressLine": full_address(spec.ADDRESS_FIELDS),
            "formattedcheckintimec": hhmm_time("checkintimec"),
            "formattedcheckouttimec": hhmm_time("checkouttimec"),
            "SELECTHotelFlag": initial_flag("programaffiliationc", "S"),
            "CuratedHotelFlag": initial_flag("programaffiliationc", "C"),
        }
    )
    return fill_blank(apply_mapping(standardized, spec.silver_mapping()))


def _with_lookups(
    hotels: DataFrame,
    brands: DataFrame,
    country_ref: DataFrame,
    brand_ref: DataFrame,
    dial_plan: DataFrame,
    broadcast: bool | None,
) -> DataFrame:
    """``hotels`` with brand name, country, brand and dial plan columns.

    Small lookups are broadcast, one after another.  Otherwise they are resolved on the
    distinct pairs of the hotels' two keys, which are narrow.  The resolved pairs are
    broadcast where they are few and ``broadcast`` leaves that open; else the wide rows
    are shuffled once, to the pairs.
    """

    def resolved(rows: DataFrame) -> DataFrame:
        named = lookup_join(
            rows,
            brands,
            ("hotelbrandc", "id"),
            {"brandname": "name"},
            [TIMESTAMP, "lastupdatedtimestamp"],
            broadcast,
        )
        referred = enrich_reference(
            named,
            {
                "countryc": Reference(country_ref, "iso3char", spec.COUNTRY_COLUMNS),
                "brandname": Reference(brand_ref, "brbrandname", spec.BRAND_COLUMNS),
            },
            broadcast,
        )
        return with_dial_plan(referred, "iso2char", dial_plan, broadcast)

    if broadcast:
        return resolved(hotels)
    keys = ["hotelbrandc", "countryc"]
    pairs = resolved(hotels.select(*keys).distinct())
    pair = F.struct(*keys)
    resolved_pairs = pairs.select(pair.alias("__key"), *[c for c in pairs.columns if c not in keys])
    # Counted as the distinct pairs, which costs no lookup: each stays one row.
    (few,) = fits_broadcast(hotels.select(*keys).distinct(), max_rows=MAX_BROADCAST_PAIRS)
    return attach(hotels, resolved_pairs, pair, few and broadcast is None, hashed=few)


def gold_batch(silver: DataFrame) -> DataFrame:
    """The gold columns that silver rows set, all strings."""
    return apply_mapping(
        silver,
        spec.gold_mapping(),
        {spec.SOURCE_SYSTEM_COLUMN: spec.SOURCE_SYSTEM},
        cast="string",
    )


@dataclass(frozen=True)
class HotelRun:
    """One run over a hotel drop and a brand drop.

    Every file becomes a load, and a ledger keeps the stage each load has reached.  Which
    keys a load changes is written down before a layer is merged; the merge, the next
    layer and the export take exactly these keys.  So whatever step a run dies in, the
    next run ends its loads first, with the same rows and the same stamps, and nothing
    hangs on clocks or on a context of its own.  Loads are taken one after another,
    oldest file first; an export holds what all loads since the last export have changed.

    Rows without a key are kept in the ``rejected`` table, with the load and the reason;
    ``replay`` brings them back mended.  One run at a time.
    """

    spark: SparkSession
    ctx: RunContext
    country_ref: DataFrame
    brand_ref: DataFrame
    dial_plan: DataFrame
    tables: HotelTables
    code_mode: str = "strip"
    # Numbers of other countries have to fit the dial plan of theirs.
    check_foreign: bool = False
    only_if_changed: bool = False
    # One CSV file, written by one task, instead of a folder of parts.
    single_export: bool = False
    # All files that no load is of yet, instead of the newest file alone (loaded or not).
    every_unseen: bool = False
    # Rows that repeat a key within their load: keep them apart, or stop the run.
    reject_repeats: bool = False

    @property
    def ledger(self) -> RunLedger:
        return RunLedger(self.spark, self.tables.named("ledger"), STAGES)

    def run(self, hotel_path: str, brand_path: str, export_dir: str) -> RunSummary:
        """Drops to CSV.  Without a valid hotel or brand file nothing is written."""
        key, value = COMMON_METHODS
        former = self.spark.conf.get(key)
        self.spark.conf.set(key, value)
        try:
            return self._run(hotel_path, brand_path, export_dir)
        finally:
            self.spark.conf.set(key, former)

    def _run(self, hotel_path: str, brand_path: str, export_dir: str) -> RunSummary:
        if not self.begin(hotel_path, brand_path):
            return RunSummary("no valid files")
        summary = RunSummary("done")
        for load, _ in self.ledger.pending("brand", "bronze"):
            self.bronze(load, brand_path, self.tables.bronze_brand)
            summary.brand_file = load.file
        for load, stage in self.ledger.pending("hotel"):
            if stage == "found":
                self.bronze(load, hotel_path, self.tables.bronze_hotel)
            if STAGES.index(stage) < STAGES.index("silver"):
                self.silver(load, stage, summary)
            if STAGES.index(stage) < STAGES.index("gold"):
                self.gold(load, stage)
            summary.loads.append(load.load)
            summary.hotel_file = load.file
        if not summary.loads:
            summary.status = "nothing new"
        self.export(export_dir, summary)
        return summary

    def begin(self, hotel_path: str, brand_path: str) -> bool:
        """Enter the drops' files as loads; False where one of the drops never had a valid file."""
        found = {kind: self._found(kind, path) for kind, path in (("hotel", hotel_path), ("brand", brand_path))}
        known = self.ledger.kinds()
        if not all(files or kind in known for kind, files in found.items()):
            return False
        open_ = {load.batch_id for load, _ in [*self.ledger.pending("hotel"), *self.ledger.pending("brand", "bronze")]} if known else set()
        self.ledger.begin([f for files in found.values() for f in files if f.batch_id not in open_], "found")
        return True

    def _found(self, kind: str, path: str) -> list[Load]:
        """The drop's files to load, oldest first: their stamps are in the footers, others' columns are scanned."""
        try:
            files = footer_stamps(self.spark, path, TIMESTAMP)
            if self.every_unseen:
                files = self.ledger.unseen(files, kind)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise
            return []
        with staged(files, "footers") as listed:
            stamps = listed.filter("known").select("file", "file_us")
            names = [r["file"] for r in listed.filter("NOT known").select("file").collect()]
            rows = read_drop(self.spark, path, names) if names else None
            if rows is not None and TIMESTAMP in [c.lower() for c in rows.columns]:
                stamps = stamps.unionByName(file_stamps(rows, TIMESTAMP))
            stamps = stamps.filter(F.col("file_us").isNotNull())
            if not self.every_unseen:
                stamps = stamps.orderBy(F.desc("file_us"), F.desc("file")).limit(1)
            dated = stamps.join(listed.drop("file_us"), "file").orderBy("file_us", "file").collect()
        return [self._load(kind, r["file"], r["file_us"], r["size"], r["modified_us"]) for r in dated]

    def _load(self, kind: str, file: str, file_us: int, size: int, modified_us: int) -> Load:
        batch_id = NewestFile(file, EPOCH + timedelta(microseconds=file_us)).batch_id
        return Load("", kind, batch_id, file, file_us, size, modified_us, self.ctx.user, micros(self.ctx.ts))

    def bronze(self, load: Load, path: str, table: str) -> None:
        """Append one file's rows; of brands, the newest rows are kept up too."""
        # One file has few row groups, so few tasks read it; all further steps go by its partitions.
        rows = spread(sanitize_columns(read_drop(self.spark, path, load.file)))
        append_evolving(add_audit(rows, replace(self.ctx, batch_id=load.batch_id), load.file), table, load.batch_id, widen=True)
        if load.kind == "brand":
            self._keep_brands(load)
        self.ledger.reach([load], "bronze")

    def silver(self, load: Load, stage: str, summary: RunSummary) -> None:
        """Standardise one load and upsert it; rows that have no key of their own are kept apart."""
        slice_ = batch_slice(read_evolved(self.spark, self.tables.bronze_hotel), load.batch_id)
        good, rejects = self._keyed(slice_)
        brands = self._brands()
        batch = silver_batch(good, brands, self.country_ref, self.brand_ref, self.dial_plan, self.code_mode, foreign=self.check_foreign)
        with staged(batch, "silver-batch") as rows:
            audited = rows.select("*", *[F.lit(None).cast(_AUDIT_TYPES[c]).alias(c) for c in SILVER_AUDIT])
            widen_table(self.spark, self.tables.silver, audited.schema)
            self._ensure(self.tables.silver, audited.schema)
            summary.drift = schema_drift(audited, self._columns(self.tables.silver))
            known = {n.lower() for n in self.spark.table(self.tables.silver).columns}
            source = rows.select([c for c in rows.columns if c.lower() in known])
            append_evolving(rejects.withColumn("batch_id", F.lit(load.load)), self.tables.named("rejected"), load.load, widen=True)
            summary.rejected += batch_slice(self.spark.table(self.tables.named("rejected")), load.load).count()
            stamp = {"lastupdatedby": F.lit(load.run_by), "lastupdatedtimestamp": F.lit(load.run_ts)}
            new = {"createdby": F.lit(load.run_by), "createdtimestamp": F.lit(load.run_ts)}
            self._merge(load, stage, "silver", source, self.tables.silver, stamp, new)
            summary.hotels += source.count()

    def _keep_brands(self, load: Load | None) -> None:
        """Merge a load's brands into the newest row of each; all that bronze has, where there are none yet."""
        name, rows = self.tables.named("brands"), read_evolved(self.spark, self.tables.bronze_brand)
        if load and self.spark.catalog.tableExists(name) and not self.spark.table(name).isEmpty():
            rows = batch_slice(rows, load.batch_id)
        keep_newest(rows, name, "id", ["name"], [TIMESTAMP, "lastupdatedtimestamp"], self.tables.ranges)

    def _brands(self) -> DataFrame:
        """The newest row of each brand; the history is read only where a job kept no such table yet."""
        name = self.tables.named("brands")
        if not self.spark.catalog.tableExists(name):
            self._keep_brands(None)
        return self.spark.table(name)

    def gold(self, load: Load, stage: str) -> None:
        """Upsert the silver rows that a load has changed into the wide table of strings."""
        columns = self.tables.gold_columns or spec.gold_columns()
        self._ensure(self.tables.gold, string_schema(columns))
        changed = rows_of_keys(self.spark, self.tables.silver, self._changes([load], "silver"))
        at = F.lit(utc_text(load.run_ts))
        stamp = {spec.GOLD_CHANGED_BY: F.lit(load.run_by), spec.GOLD_CHANGED_AT: at}
        new = {spec.GOLD_ENTERED_BY: F.lit(load.run_by), spec.GOLD_ENTERED_AT: at}
        with staged(gold_batch(changed), "gold-batch") as rows:
            self._merge(load, stage, "gold", rows, self.tables.gold, stamp, new)

    def export(self, directory: str, summary: RunSummary) -> None:
        """Write the gold rows that loads have changed since the last export, and their keys alone, as CSV."""
        loads = [load for load, stage in self.ledger.pending("hotel") if stage == "gold"]
        if not loads:
            return
        changed = rows_of_keys(self.spark, self.tables.gold, self._changes(loads, "gold"))
        changed = changed.filter(F.col(spec.SOURCE_SYSTEM_COLUMN) == spec.SOURCE_SYSTEM)
        # The second file reads keys alone, so the rows are not written down for it.
        rows = fill_blank(changed.select(*spec.gold_sources()))
        summary.exports = [
            export_csv(rows, directory, spec.EXPORT_FILE, self.single_export),
            export_csv(rows.select("code"), directory, spec.EXPORT_CODES_FILE, self.single_export),
        ]
        self.ledger.reach(loads, "exported")
        for load in loads:
            for layer in ("silver", "gold"):
                drop_partition(self.spark, self.tables.named("changes"), {"load": load.load, "layer": layer})

    def replay(self, load: str, mend: Callable[[DataFrame], DataFrame]) -> Load:
        """Enter a load's rejected rows, mended, as a load of their own; the next run brings it to the export.

        ``mend`` gets the rows as bronze has them, with ``reason``.  Mended rows are the
        newest word on their keys, as those of a new file would be.
        """
        name = self.tables.named("rejected")
        rows = mend(batch_slice(read_evolved(self.spark, name), load)).drop("reason", "batch_id")
        first = next(x for x in self.ledger.state().filter(F.col("load") == load).collect())
        again = Load("", "hotel", f"{load}~mended", first["file"], first["file_us"], 0, 0, self.ctx.user, micros(self.ctx.ts))
        append_evolving(rows.withColumn("batch_id", F.lit(again.batch_id)), self.tables.bronze_hotel, again.batch_id, widen=True)
        (again,) = self.ledger.begin([again], "bronze")
        drop_partition(self.spark, name, {"batch_id": load})
        return again

    def _keyed(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows with a key of their own, and the others with ``reason``."""
        coded = rows.withColumn("__code", code_field("id", spec.CODE_PREFIX))
        good, blank = reject_blank_keys(coded, ["__code"])
        rejects = blank.withColumn("reason", F.lit("blank key"))
        if self.reject_repeats:
            again = good.groupBy("__code").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__code")
            rejects = rejects.unionByName(good.join(again, "__code", "left_semi").withColumn("reason", F.lit("repeated key")))
            good = good.join(again, "__code", "left_anti")
        return good.select(*rows.columns), rejects.select(*rows.columns, "reason")

    def _merge(self, load: Load, stage: str, layer: str, rows: DataFrame, table: str, stamp: dict, new: dict) -> None:
        """Upsert those rows of a load that change the table; which ones is settled only once."""
        schema = self.spark.table(table).schema
        hashed = ROW_HASH if ROW_HASH in schema.names else None
        if hashed:
            rows = with_row_hash(rows, schema, ["Code"], ROW_HASH)
        if STAGES.index(stage) < STAGES.index(f"{layer} planned"):
            target = self.spark.table(table)
            # Without a known key all rows are new, and no whole rows are compared.
            compare = self.only_if_changed and any_known(target, rows, ["Code"])
            many = many_partitions(self.spark, target.count(), rows.count())
            keys = changed_keys(target, rows, ["Code"], row_hash=hashed, partitions=many) if compare else rows.select("Code")
            with staged(keys, f"{layer}-keys") as changed:  # found by whole rows, and read twice
                once = changed.groupBy("Code").count().filter("count > 1").isEmpty()
                if once:
                    replace_partition(changed, self.tables.named("changes"), {"load": load.load, "layer": layer}, CHANGES)
            if once:
                self.ledger.reach([load], f"{layer} planned")
            else:  # says what is wrong, and writes nothing
                merge_table(rows, table, ["Code"])
        both = {**stamp, **new}
        if self.only_if_changed:
            # Both sides are written down already; most readings are of keys alone.
            merge_table(of_keys(rows, self._changes([load], layer)), table, ["Code"], stamp, both)
        else:  # all of them, as often as the step is taken
            merge_table(rows, table, ["Code"], stamp, both)
        self.ledger.reach([load], layer)

    def _changes(self, loads: Sequence[Load], layer: str) -> DataFrame:
        """The keys that loads change in a layer; one that several loads change, several times."""
        table = self.spark.table(self.tables.named("changes"))
        mine = F.col("load").isin([load.load for load in loads]) & (F.col("layer") == layer)
        return table.filter(mine).select("Code")

    def _ensure(self, name: str, schema: StructType) -> None:
        if self.tables.row_hash:
            schema = StructType([*schema.fields, StructField(ROW_HASH, StringType())])
        ensure_table(self.spark, name, schema, bucket_by=["Code"], buckets=self.tables.buckets, ranges=self.tables.ranges)

    def _columns(self, name: str) -> StructType:
        """A table's columns without those of its layout and its hash."""
        return StructType([f for f in self.spark.table(name).schema.fields if f.name not in (RANGE_COLUMN, ROW_HASH)])


_AUDIT_TYPES = {"createdby": "string", "lastupdatedby": "string", "createdtimestamp": "timestamp", "lastupdatedtimestamp": "timestamp"}
