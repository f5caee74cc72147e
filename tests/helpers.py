def texts(spark, column, values):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def values(df, column):
    return [row[column] for row in df.collect()]
