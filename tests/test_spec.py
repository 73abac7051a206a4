from collections import Counter

from hitloom import spec


def test_compact_has_84_columns_with_declared_type_counts():
    assert len(spec.COMPACT_NAMES) == 84
    types = Counter(spec.compact_types().values())
    assert types == {"string": 47, "bigint": 23, "variant": 9, "boolean": 4, "date": 1}


def test_exploded_has_267_columns_with_declared_type_counts():
    assert len(spec.EXPLODED_NAMES) == 267 == len(set(spec.EXPLODED_NAMES))
    types = Counter(c.type for c in spec.EXPLODED)
    assert types == {"string": 124, "bigint": 98, "variant": 31, "boolean": 13, "date": 1}


def test_exploded_order_rule():
    names = spec.EXPLODED_NAMES
    assert spec.HASH_COLUMN not in names
    i = names.index("customDimensions")
    assert names[i + 1:i + 3] == ["customDimensions_index", "customDimensions_value"]
    assert names.index("hits") == names.index("privacy_info_uses_transient_token") + 1
    assert names[-1] == "hits_product_productListPosition"


def test_names_follow_element_and_path():
    for c in spec.EXPLODED:
        expect = "_".join(p for p in (c.element, c.path.replace(".", "_")) if p)
        assert c.name == expect


def test_flatten_chain_inner_only_for_hits_and_promotions():
    inner = [a for a, _, _, outer in spec.FLATTEN_CHAIN if not outer]
    assert inner == ["hits", "hits_promotion"]
