"""What the blocks of op11 take on disk."""

import pyarrow.parquet as pq
from public_tokenizers import path

from spendgrid.llm import bpe


def test_blocks_are_written_compressed(spark, tmp_path):
    docs = spark.createDataFrame([(i, " ".join(f"word{j}x{i}" for j in range(500))) for i in range(4)], "doc_id long, text string")
    blocks = bpe.write_blocks(docs, path("word_bpe_49k.json"), f"file://{tmp_path}/blocks")
    assert blocks.where("words IS NOT NULL").count() > 0
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "blocks").iterdir() if f.name.endswith(".parquet")]
    assert files and {m.row_group(g).column(c).compression for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)} == {"ZSTD"}
