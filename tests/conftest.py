import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from check import session

    spark = session("tests", 4)
    yield spark
    spark.stop()


# The sample corpus and its labels.
SAMPLE_ARCS = [
    "chair\tfurniture/NN/acomp/0 like/VB/xcomp/1 chair/NN/prep/2",
    "chair\tfurniture/pobj/acomp/0 like/VB/xcomp/1 tahat/NN/prep/2",
    "furniture\tfurniture/NN/acomp/0 as/JJ/prep/1 sofa/NN/advmod/2 chair/NN/xcomp/2",
    "able\table/NN/acomp/0 dramatize/NN/xcomp/1 them/PRP/dobj/2",
]
SAMPLE_LABELS = ["chair   furniture   true", "sofa   furniture   true", "chair   aircraft    false"]


@pytest.fixture(scope="session")
def lines(spark):
    def make(values):
        return spark.createDataFrame(list(enumerate(values, 1)), "line_id bigint, value string")

    return make


@pytest.fixture(scope="session")
def sample(lines):
    from pathfeat.operators.parse import parse_arcs, parse_labels

    return parse_arcs(lines(SAMPLE_ARCS)), parse_labels(lines(SAMPLE_LABELS).select("value"))
