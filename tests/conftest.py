import os
import sys
import tempfile

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skein.session import build_session
    scratch = tempfile.mkdtemp(prefix="skein-test-")
    s = build_session("local[4]", shuffle_partitions=8, driver_memory="8g",
                      extra_conf={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from skein.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture(scope="session", autouse=True)
def shared_tables():
    """Queries of one session share the derived graph, index, collection and
    models, which every query would otherwise build anew."""
    from skein.plans import queries_models, registry
    made, old = {}, []

    def once(name, build):
        def get(spark, sf_dir, **options):
            key = (name, sf_dir, str(options))
            if key not in made:
                made[key] = build(spark, sf_dir, **options)
            return made[key]
        return get

    for module, names in ((registry, ("_graph", "_index", "_collection", "_retrieval")), (queries_models, ("_index", "_sources", "_binary_model", "_multiclass"))):
        for name in names:
            build = getattr(module, name)
            old.append((module, name, build))
            setattr(module, name, once(name, build))
    yield
    for module, name, build in old:
        setattr(module, name, build)
