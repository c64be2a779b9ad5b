"""How often each distinct value or term occurs, in how many rows, and whether that is too rare or too common.

Map tasks count their own rows (DuckDB over Arrow batches) and send one row per distinct term;
Spark's exchange spreads terms by hash; a reduce task then partitions its terms by further hash
bits into files on disk, splits files that are still too large by the next bits, and sums each
file out of core with DuckDB. A term that occurs everywhere costs one row per map chunk, so a hot
term needs no salt. Spill files belong to one task and vanish with it; a lost executor's tasks
simply run again.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import cut_lineage

WORD = r"[\p{L}\p{M}\p{N}]+"
PARTIAL = pa.schema([("field_name", pa.string()), ("term", pa.string()), ("occurrences", pa.int64()), ("n_rows", pa.int64())])
BITS = 4


def _duck(tmp: str, memory_mb: int):
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": f"{memory_mb}MB", "temp_directory": tmp, "preserve_insertion_order": False})


def _special_case(chunk: pa.Table) -> pa.Table:
    """Lower-cases in advance the rare values whose case depends on context (final sigma, dotted I)."""
    values = chunk.column("value")
    odd = pc.and_(chunk.column("is_text"), pc.or_(pc.match_substring(values, "Σ"), pc.match_substring(values, "İ")))
    if not pc.any(odd).as_py():
        return chunk
    lowered = pa.array([v.lower() if o else v for v, o in zip(values.to_pylist(), odd.to_pylist())], pa.string())
    return chunk.set_column(chunk.schema.get_field_index("value"), "value", lowered)


def _partial(con, chunk: pa.Table) -> pa.Table:
    """Occurrences and rows of each term of a chunk (field_name, value, is_text); the rows of a field have a NULL term."""
    chunk = _special_case(chunk)
    con.register("chunk", chunk)
    got = con.sql(
        f"""
        WITH r AS (
          SELECT field_name, row_number() OVER () AS rid,
                 CASE WHEN is_text THEN regexp_extract_all(lower(value), '{WORD}') ELSE [value] END AS terms
          FROM chunk),
        t AS (SELECT field_name, rid, unnest(terms) AS term FROM r),
        d AS (SELECT field_name, rid, term, count(*) AS c FROM t GROUP BY ALL)
        SELECT field_name, term, sum(c)::BIGINT AS occurrences, count(*)::BIGINT AS n_rows FROM d GROUP BY ALL
        UNION ALL SELECT field_name, NULL, 0, count(*) FROM chunk GROUP BY field_name
        """
    ).to_arrow_table()
    con.unregister("chunk")
    return got.cast(PARTIAL)


def _merge(con, source) -> pa.Table:
    con.register("part", source)
    got = con.sql("SELECT field_name, term, sum(occurrences)::BIGINT AS occurrences, sum(n_rows)::BIGINT AS n_rows FROM part GROUP BY ALL").to_arrow_table()
    con.unregister("part")
    return got.cast(PARTIAL)


class RadixSpill:
    """Sums partial counts that may exceed memory, by recursive radix partitioning on disk.

    Up to ``limit`` bytes stay in memory and are summed there. Beyond, rows go to 2**BITS files by
    the next hash bits; a file above ``limit`` is split again, to ``depth`` levels. A file that
    cannot be split (few distinct terms) is summed by DuckDB, which itself spills.
    """

    def __init__(self, limit: int, memory_mb: int, depth: int = 8) -> None:
        self.limit, self.memory_mb, self.depth = limit, memory_mb, depth
        self.files_split = 0

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        tmp = tempfile.mkdtemp(prefix="radix-", dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        con = _duck(tmp, self.memory_mb)
        try:
            yield from self._level(con, batches, tmp, 0)
        finally:
            con.close()
            shutil.rmtree(tmp, ignore_errors=True)

    def _level(self, con, batches, tmp: str, level: int) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        size = 0
        files: dict[int, tuple[str, pa.OSFile, pa.RecordBatchFileWriter]] = {}
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > self.limit:
                self._spill(con, held, files, tmp, level)
                held, size = [], 0
        if not files:
            if held:
                yield _merge(con, pa.Table.from_batches(held, PARTIAL))
            return
        self._spill(con, held, files, tmp, level)
        for path, sink, writer in files.values():
            writer.close()
            sink.close()
        for path, _, _ in files.values():
            with pa.memory_map(path) as mapped:
                reader = pa.ipc.open_file(mapped)
                if os.path.getsize(path) > self.limit and level + 1 < self.depth:
                    self.files_split += 1
                    sub = tempfile.mkdtemp(dir=tmp)
                    yield from self._level(con, (reader.get_batch(i) for i in range(reader.num_record_batches)), sub, level + 1)
                else:
                    yield _merge(con, reader.read_all())
            os.unlink(path)

    def _spill(self, con, held, files, tmp, level) -> None:
        if not held:
            return
        con.register("held", pa.Table.from_batches(held, PARTIAL))
        shift = BITS * (level + 1)
        got = con.sql(
            f"SELECT *, ((hash(field_name, term) >> {64 - shift}) & {2**BITS - 1})::INTEGER AS slot FROM held ORDER BY slot"
        ).to_arrow_table()
        con.unregister("held")
        slots = got.column("slot").combine_chunks().to_numpy()
        rows = got.drop_columns(["slot"]).cast(PARTIAL)
        start = 0
        for slot in sorted(set(slots.tolist())):
            n = int((slots == slot).sum())
            if slot not in files:
                path = os.path.join(tmp, f"{level}-{slot}.arrow")
                sink = pa.OSFile(path, "wb")
                files[slot] = (path, sink, pa.ipc.new_file(sink, PARTIAL))
            files[slot][2].write_table(rows.slice(start, n))
            start += n


def term_frequency(
    fields: list[tuple[str, DataFrame, str, bool]], rare_rows: int = 2, common_share: float = 0.2, limit_mb: int = 32, memory_mb: int = 192
) -> DataFrame:
    """``field_name, term, occurrences, n_rows, field_rows, mark`` for every term of the given fields.

    ``fields``: (name, table, column, is it text to be cut into words?). Words are maximal runs of
    letters, marks and digits of the lower-cased text; other values count whole, as text. Rows whose
    field is missing (NULL, blank or ``-``) are left out altogether, also of ``field_rows``. ``mark``
    is ``rare`` up to ``rare_rows`` rows, ``common`` above ``common_share`` of the field's rows (rare
    goes first), else NULL. All rows count: there is no sample and no cut-off.
    """
    parts = [
        df.select(F.lit(name).alias("field_name"), F.col(column).cast("string").alias("value"), F.lit(text).alias("is_text")) for name, df, column, text in fields
    ]
    rows = reduce(DataFrame.unionAll, parts)
    rows = rows.where(F.col("value").isNotNull() & ~F.regexp_replace("value", r"[\s\p{Z}]+", "").isin("", "-"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tmp = tempfile.mkdtemp(prefix="terms-", dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        con = _duck(tmp, memory_mb)
        try:
            held, size = [], 0
            for batch in batches:
                held.append(batch)
                size += batch.nbytes
                if size > limit_mb << 19:
                    yield from _partial(con, pa.Table.from_batches(held)).to_batches()
                    held, size = [], 0
            if held:
                yield from _partial(con, pa.Table.from_batches(held)).to_batches()
        finally:
            con.close()
            shutil.rmtree(tmp, ignore_errors=True)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in RadixSpill(limit_mb << 20, memory_mb).run(batches):
            yield from got.to_batches(max_chunksize=50_000)

    schema = "field_name string, term string, occurrences bigint, n_rows bigint"
    # stored, so that the texts are read once for both terms and rows
    counted = cut_lineage(rows.mapInArrow(count, schema).repartition("field_name", "term").mapInArrow(total, schema))
    # one row for each field name, whatever the size of the data
    totals = counted.where("term IS NULL").select("field_name", F.col("n_rows").alias("field_rows"))
    share = F.col("n_rows") > F.lit(common_share) * F.col("field_rows")
    mark = F.when(F.col("n_rows") <= rare_rows, "rare").when(share, "common")
    return counted.where("term IS NOT NULL").join(F.broadcast(totals), "field_name").withColumn("mark", mark)
