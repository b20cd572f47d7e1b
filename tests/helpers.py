from __future__ import annotations


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def one(spark, value, kind, *functions):
    """Result of column functions applied to a single value."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(*[f(F.col("v")).alias(str(i)) for i, f in enumerate(functions)]).first()[0]


def shuffled(df):
    """Schemas of what a plan shuffles, as text."""

    def walk(node):
        inner = node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else None
        children = [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]
        return ([node.schema().catalogString()] if node.nodeName() == "Exchange" else []) + [s for c in children for s in walk(c)]

    return walk(df._jdf.queryExecution().executedPlan())
