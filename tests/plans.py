"""What a DataFrame's physical plan looks like, for tests."""


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return physical(df).count("Exchange ") - physical(df).count("BroadcastExchange ")
