"""The registered queries beside their SQL, or beside plain versions where SQL cannot express them."""

import os

import pytest

import corpus_pipeline
from quadrata.llm.queries import LLM

from .. import oracle

FOLDER = os.environ.get("QUADRATA_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(name for name, q in LLM.items() if q.oracle))
def test_query(spark, con, name):
    assert oracle.differences(spark, con, FOLDER, name, LLM) == []
