"""Text of physical plans, for tests that look at their nodes."""

#: Nodes in which rows pass through a Python worker.
PYTHON = r"(?:MapInPandas|MapInArrow|EvalPython|InPandas|InArrow|PythonUDF|BatchEvalPython)"


def planned(df) -> str:
    """The plan before it runs, without the copy that adaptive execution keeps of it."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def final_plan(df) -> str:
    """The executed plan after adaptive changes."""
    df.collect()
    return planned(df)
