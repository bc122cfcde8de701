"""Whole texts go to Python in batches that are bounded in bytes."""

import public_tokenizers
import pyarrow as pa
from pyspark.sql.readwriter import DataFrameWriter

from stratum.llm import packing, quality
from stratum.llm.catalog import TOKENIZER
from stratum.session import ARROW_BYTES, small_batches
from tests.llm import fixtures as fx


def test_figures_and_pieces_are_written_from_small_batches(spark, monkeypatch):
    before, seen, write = spark.conf.get(ARROW_BYTES), {}, DataFrameWriter.parquet

    def noted(self, path, *args, **kw):
        seen[path.split("/")[-1].rsplit("-", 1)[0]] = spark.conf.get(ARROW_BYTES)
        return write(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    docs = spark.createDataFrame([fx.doc(i, fx.prose(i, 3000 if i == 3 else 30)) for i in range(8)] + [fx.doc(None, None)], fx.DOCS)
    got = packing.pack_documents(docs, public_tokenizers.path(TOKENIZER)).collect()
    assert len(quality.quality_rules(docs).collect()) == 9
    assert seen["pieces"] == seen["quality-figures"] == "4m" and seen["packed"] == spark.conf.get(ARROW_BYTES) == before
    assert {r["doc_id"] for r in got} == {None, *range(8)} and max(r["piece"] for r in got) > 0
    assert [(r["start"], r["length"]) for r in got if r["doc_id"] is None] == [(0, 1)]


def test_a_batch_holds_rows_up_to_its_bytes_and_all_rows_come(spark):
    docs = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('abcdefghij', 1000) as text")

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([b.column("id"), pa.array([b.num_rows] * b.num_rows, pa.int64())], ["id", "n"])

    with small_batches(spark):
        rows = docs.mapInArrow(sizes, "id long, n long").collect()
    assert sorted(r["id"] for r in rows) == list(range(3000)) and max(r["n"] for r in rows) < 600
