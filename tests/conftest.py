import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)


@pytest.fixture(scope="session")
def spark():
    from feedloom.session import build_session, clear_scratch

    session = build_session(
        "feedloom-tests", "local[8]",
        spark__sql__shuffle__partitions="4", spark__driver__memory="6g", spark__default__parallelism="4",
        spark__ui__showConsoleProgress="false", spark__sql__session__timeZone="UTC",
    )
    # Compiling code for a handful of rows costs more than interpreting it. The queries
    # of test_oracle run compiled.
    if os.environ.get("FEEDLOOM_TEST_CODEGEN") != "1":
        session.conf.set("spark.sql.codegen.wholeStage", "false")
        session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def compiled(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def hot(spark):
    """Treat any key with more than a few rows as hot."""
    spark.conf.set("feedloom.hotRows", "10")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.unset("feedloom.hotRows")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
