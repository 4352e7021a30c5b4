import json

from playerledger import catalog
from playerledger.plans import PlanContext
from playerledger.sources.dims import dimension_from_lines
from playerledger.streaming.batch import pipeline_changes


def raw(spark, events, topic="t", partition=0):
    rows = [(json.dumps(e), topic, partition, i) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "value string, topic string, partition int, offset long")


def dims(spark, pipelines, lines=None):
    lines = lines or {}
    out = {}
    for d in catalog.dims_for(pipelines):
        k, n = catalog.DIM_POSITIONS[d]
        text = lines.get(d, [])
        df = spark.createDataFrame([(t,) for t in text], "value string")
        out[d] = dimension_from_lines(df, d, k, n)
    return out


def changes(spark, pipeline, events, dim_lines=None, rates=None):
    return pipeline_changes(raw(spark, events), pipeline, dims(spark, [pipeline], dim_lines), PlanContext(rates=rates))
