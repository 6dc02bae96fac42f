"""Every registered query against its SQL oracle on the smallest tables."""

import pytest
from compare import difference

from pulsegrid.plans.oracles import ORACLES
from pulsegrid.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_matches_oracle(spark, name):
    assert difference(spark, SF, REGISTRY[name], ORACLES[name]) is None
