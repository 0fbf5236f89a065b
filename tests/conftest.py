import pytest

from graphprep.workspace import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def triples(spark):
    from graphprep.sources.tables import triples_from_rows

    return lambda *rows: triples_from_rows(spark, [tuple(row.split()) if isinstance(row, str) else row for row in rows])
