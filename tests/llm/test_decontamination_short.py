"""Short items, and items in scripts without blanks."""

from itertools import combinations

import pyarrow as pa
import pytest

from loanloom.llm import decontamination


def found(item, doc):
    index = decontamination.SeedIndex.build(["i"], [item])
    return index.overlaps(*decontamination.item_words(pa.array([None, doc], pa.large_string()))).get((1, 0))


@pytest.mark.parametrize("n", range(5, 12))
def test_short_items_bear_a_quarter_of_substitutions(n):
    item = [f"w{i}" for i in range(n)]
    for k in range(4):
        for gone in combinations(range(n), k):
            doc = ["left"] + ["other" if i in gone else w for i, w in enumerate(item)] + ["right"]
            assert found(" ".join(item), " ".join(doc)) == ((n, n - k, 1, 0) if k <= n // 4 else None)


def test_scripts_without_blanks_count_by_character():
    item = "人工智能正在改变人们的生活方式,许多公司已经开始使用它"
    assert found(item, "前言。" + item.replace(",", "、") + "。后记")[:2] == (26, 26)
    assert found(item, "说明" + item.replace("公司", "单位"))[:2] == (26, 24)
    assert found(item, "昨天天气很好,我们去公园散步了,孩子们非常开心") is None
    assert found("日本の首都はどこですか", "問題:日本の首都はどこですか?東京です")[:2] == (11, 11)
    assert found("เมืองหลวงของประเทศไทยคืออะไร", "ถามว่าเมืองหลวงของประเทศไทยคืออะไรครับ") is not None
