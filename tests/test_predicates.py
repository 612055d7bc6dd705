import datetime

import pytest
from pyspark.errors import AnalysisException

from lakelayers.functions.predicates import predicate


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", datetime.date(2024, 1, 1)), (2, "o'hara", datetime.date(2024, 1, 2)), (3, None, None)],
        "id int, name string, day date",
    )


@pytest.mark.parametrize("filters, ids", [
    (None, [1, 2, 3]),
    ({}, [1, 2, 3]),
    ({"name": "a"}, [1]),
    ({"name": "o'hara"}, [2]),
    ({"name": ["a", "o'hara"]}, [1, 2]),
    ({"name": ("a",)}, [1]),
    ({"name": []}, []),
    ({"name": None}, [3]),
    ({"name": ["a", None]}, [1, 3]),
    ({"name": [None]}, [3]),
    ({"day": datetime.date(2024, 1, 1)}, [1]),
    ({"id": [1, 2], "name": "a"}, [1]),
])
def test_filters(rows, filters, ids):
    found = rows.filter(predicate(filters)).orderBy("id").collect()
    assert [row["id"] for row in found] == ids


def test_unknown_column(rows):
    with pytest.raises(AnalysisException):
        rows.filter(predicate({"nothing": 1})).collect()
