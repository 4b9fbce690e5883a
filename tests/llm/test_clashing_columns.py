"""Columns of the input keep their names and values, whatever helper names an operator uses."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from hourcast.llm import bpe, decontaminate, fill_in_middle, quality, reshard, simhash, substring
from hourcast.llm._frames import aside, fresh

EXTRA = ["__text", "__row_id", "__row_crc", "__spans", "__id", "__hash", "__d", "__h", "__size", "__old", "__class",
         "__sub", "spans", "offset", "source_text", "kept_0", "node", "fp", "h", "k", "value"]
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def docs(spark):
    window = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"{window} tail{i}" if i < 3 else f"text number {i}", "en") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(EXTRA)})


OPERATORS = {
    "substring": lambda s, d: substring.remove_repeats(s, d),
    "simhash": lambda s, d: simhash.keep_one(s, d),
    "quality": lambda s, d: quality.score(s, d, None),
    "bpe": lambda s, d: bpe.roundtrip(s, d, PATH),
    "fill_in_middle": lambda s, d: fill_in_middle.transform(s, d, restored=True),
    "reshard": lambda s, d: reshard.reshard(s, d, F.pmod("doc_id", F.lit(2)), 2, 3),
    "decontaminate": lambda s, d: decontaminate.drop_contaminated(
        s, d, s.createDataFrame([(1, "text number 4")], "item_id long, text string")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_are_kept(spark, name):
    out = OPERATORS[name](spark, docs(spark))
    assert set(EXTRA) <= set(out.columns)
    rows = out.collect()
    assert rows and all(r[c] == i for r in rows for i, c in enumerate(EXTRA))
    if name == "decontaminate":
        assert 4 not in {r.doc_id for r in rows} and len(rows) == 7


def test_fresh_names_and_columns_put_aside(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, a_ int, __x int")
    assert fresh(df, "a", "b", "B") == ["a__", "b", "B_"]
    moved, back = aside(df, "a_", but=("A",))
    assert not {"a_", "__x"} & set(moved.columns) and back(moved).columns == df.columns
