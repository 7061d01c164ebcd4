import pytest

from listmill.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_options(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield set_options
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    """The plan as it was after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
