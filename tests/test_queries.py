"""Every registered query against its SQL counterpart."""

import pytest
from compare import differences, duck

from packetloom.plans.oracle import ORACLES
from packetloom.plans.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duck(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    assert differences(spark, con, FOLDER, name) == ""
