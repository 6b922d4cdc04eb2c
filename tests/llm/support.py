"""Fixtures and brute-force helpers of several tests."""

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang), with columns that clash with others."""

    def make(*rows, parts=2):
        full = [
            (row[0], row[1], row[2] if len(row) > 2 else None, "src", 7) for row in rows
        ]
        docs = spark.createDataFrame(full, DOCS).repartition(parts)
        return docs.selectExpr("*", "'x' AS row", "'y' AS key", "1 AS n", "'z' AS line")

    return make


@pytest.fixture
def make_table(spark):
    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def by_id(df, *columns):
    return {row[0]: tuple(row)[1:] for row in df.select("doc_id", *columns).collect()}


def groups_of(nodes, links):
    """Connected groups as a set of frozensets."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    out = {}
    for n in nodes:
        out.setdefault(top(n), set()).add(n)
    return {frozenset(group) for group in out.values()}
