import os

import duckdb
import pytest

FOLDER = os.environ.get("TIDEMARK_TEST_DATA", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def checkpoint_dir(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stored")))


@pytest.fixture(scope="session")
def sql_rows():
    """Rows of a DuckDB statement over the tables of a folder, or over given frames."""

    def run(sql, folder=FOLDER, **frames):
        con = duckdb.connect()
        for name in ("documents", "labels", "conversations", "benchmark", "embeddings"):
            if name not in frames:
                con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        for name, rows in frames.items():
            con.register(name, rows)
        cursor = con.execute(sql)
        names = [d[0] for d in cursor.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        return [names[i] for i in order], sorted(
            (tuple(plain(row[i]) for i in order) for row in cursor.fetchall()), key=key
        )

    return run


@pytest.fixture(scope="session")
def spark_rows():
    def run(df):
        names = sorted(df.columns)
        return names, sorted((tuple(map(plain, row)) for row in df.select(*names).collect()), key=key)

    return run


@pytest.fixture
def documents(spark):
    """A documents table of (id, text), or of (id, text, lang, source)."""

    def build(rows):
        full = [(*row, *(["en", "s"][len(row) - 2 :] if len(row) < 4 else []), 0) for row in rows]
        return spark.createDataFrame(full, DOCS)

    return build


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def key(row):
    return [(v is None, str(v)) for v in row]
