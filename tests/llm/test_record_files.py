"""How large the record files get by default."""

import pathlib

from kerbside.llm import records
from kerbside.llm.queries import TOKENIZER


def test_default_files_stay_small(spark, tmp_path):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(concat('word ', id, ' '), 5000) AS text")
    records.write_records(docs, str(tmp_path / "files"), TOKENIZER)
    sizes = [f.stat().st_size for f in pathlib.Path(tmp_path / "files").glob("part-*")]
    assert len(sizes) > 1 and max(sizes) < 16 << 20
