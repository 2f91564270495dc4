"""What a worker kept for a task goes where a later stage has no use for it."""

from pyspark.sql import types as T

from voxmill.llm import near_join
from voxmill.llm.rows import map_slices


def test_words_of_near_join_go_with_their_task(spark):
    texts = [(i, f"alpha beta gamma delta word{i} and some more") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert near_join.join(docs).count() == 40

    def left(ids):
        from voxmill.llm import near_join

        yield (len(near_join._SHINGLER.known),)

    schema = T.StructType([T.StructField("n", T.IntegerType())])
    assert {r.n for r in map_slices(spark.range(16).repartition(8), schema, left).collect()} == {0}
