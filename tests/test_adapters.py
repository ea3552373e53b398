"""Adapters produce exactly the declared clean aspect schemas."""

import pytest

from tickframe.schemas import ASPECTS, clean_schema
from tickframe.sources import adapters

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("aspect", [a for a in ASPECTS if a in adapters.ADAPTERS])
def test_adapter_schema(spark, aspect):
    df = adapters.ADAPTERS[aspect](spark, SF)
    want = [(f.name, f.dataType) for f in clean_schema(aspect).fields if f.name != "replay_id"]
    got = [(f.name, f.dataType) for f in df.schema.fields if f.name != "replay_id"]
    assert got == want
    assert df.limit(1).count() == 1


def test_all_aspects_have_adapters():
    assert set(ASPECTS) <= set(adapters.ADAPTERS)
