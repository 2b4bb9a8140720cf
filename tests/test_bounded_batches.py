"""Memory of a task that weighs documents follows a few rows, not the batch it is given."""

import pyarrow as pa
from pyspark.sql import functions as F

from folio.operators import terms


def test_documents_are_weighed_a_few_at_a_time(spark):
    bags = spark.createDataFrame([(0, [("a", 1)])], "id long, bag array<struct<term:string,n:bigint>>")
    vocabulary = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "term string, idf double")
    seen = {}

    class Watched:
        schema, sparkSession = bags.schema, bags.sparkSession

        def mapInArrow(self, function, schema):
            seen["function"] = function

    terms.transform_with_vocabulary(Watched(), vocabulary)
    rows = 1000
    bag = pa.array([[{"term": "a", "n": 1 + i % 3}, {"term": "x", "n": 9}] for i in range(rows)], bags_type())
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows)), bag], names=["id", "bag"])
    out = list(seen["function"](iter([batch])))
    assert [i for b in out for i in b.column("id").to_pylist()] == list(range(rows))
    assert all(b.num_rows <= terms.WEIGHED_ROWS for b in out) and len(out) > 1
    assert all(w == 1.0 for b in out for w in b.column("tfidf").to_pylist())


def bags_type():
    return pa.list_(pa.struct([("term", pa.string()), ("n", pa.int64())]))
