"""Near duplicates among many texts of one template, alike but below the threshold."""
import random

import pytest

from fraudlake.llm import neardup


@pytest.mark.parametrize("region", [1024, 4])
def test_partners_in_a_crowd(spark, monkeypatch, region):
    monkeypatch.setattr(neardup, "REGION_ROWS", region)
    monkeypatch.setattr(neardup, "WINDOW", 1)
    if region == 4:
        monkeypatch.setattr(neardup, "HEAVY", 64, raising=False)
    template = [f"t{i}" for i in range(600)]
    texts = []
    for i in range(80):  # two texts of a pair share 595 of 601 shingles, any others 592 of 604 or fewer
        w = list(template)
        w[7 * i + 2] = f"u{i}"
        two = list(w)
        two[7 * i + 6] = f"v{i}"
        texts += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(two))]
    random.Random(21).shuffle(texts)
    out = neardup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 3, (985, 1000)).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: i - i % 2 for i in range(160)}
