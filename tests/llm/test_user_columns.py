"""Stages leave the caller's columns alone, whatever their names."""

import pytest
from pyspark.sql import functions as F

from tillroll.llm import mixing, pii, simhash

NAMES = [
    "_key", "_row", "_source", "_turn", "_index", "_share", "_bucket", "_before", "_user", "_text", "_order", "_n", "at", "n", "period",
    "_id", "_spans", "_text_key", "found", "__found", "base", "user", "own_id", "own_key", "id", "key", "row", "order", "text_key",
    "first_id", "first_text", "group_mark", "component_id", "mark", "root", "cue", "kind", "lo", "hi", "value", "dotted.name", "tick`ed", "user_0", "user_7",
]


@pytest.fixture(scope="module")
def rows(spark):
    texts = ["call +1 555 123 4567 now", "plain words here", None, "", "mail a@b.co or c@d.org today"]
    data = [(i, texts[i % 5] and f"{texts[i % 5]} {i}", "en", f"s{i % 3}", None, *[f"{n}-{i}" for n in NAMES]) for i in range(25)]
    kinds = ", ".join("`" + n.replace("`", "``") + "` string" for n in NAMES)
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {kinds}")


@pytest.mark.parametrize("stage", [simhash.one_per_group, pii.redacted, pii.annotated, mixing.mixed])
def test_values_stay(rows, stage):
    out = stage(rows)
    names = [n for n in NAMES if not (stage is pii.annotated and n in ("base", "found"))]
    stays = [c for c in rows.columns if c in names or c not in NAMES]
    assert [c for c in out.columns if c in stays] == stays
    found = out.collect()
    assert len(found) == (25 if stage is not simhash.one_per_group else len({r["doc_id"] for r in found}))
    for r in found:
        for n in names:
            assert r[n] == f"{n}-{r['doc_id']}"


def test_one_row_stays_among_equal_ids_and_texts(spark):
    data = [(1, "same words in both rows", "s1"), (1, "same words in both rows", "s2"), (1, "same words in both rows", "s3")]
    kept = [
        [tuple(r) for r in simhash.one_per_group(spark.createDataFrame(d, "doc_id long, text string, source string").coalesce(1)).collect()]
        for d in (data, data[::-1], data[1:] + data[:1])
    ]
    assert len(kept[0]) == 1 and kept[0] == kept[1] == kept[2]
    with_map = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    assert len(simhash.one_per_group(with_map).collect()) == 1
