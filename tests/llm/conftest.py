import random

import pytest

WORDS = "the of and river stone letter harbor winter bread market copper window engine garden silver paper".split()
COLUMNS = "doc_id long, text string, TEXT string, score double, n_words long, kept boolean, spans string"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) * rng.randrange(2) for _ in range(n))


def edge_rows():
    """Documents with nulls, empty and very long texts, ties and repeated rows."""
    a, long = prose(1, 120), prose(2, 9000)
    near = a.split()
    near[60] = "other"
    quote = " ".join(prose(3, 40).split()[5:25])
    return [
        (1, a),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, a),
        (5, a),
        (6, " ".join(near)),
        (7, long),
        (8, long + " tail " + a),
        (9, f"{prose(4, 30)} {quote} {prose(5, 30)}"),
        (10, f"Mail ann.b@mail.example.org, 10.1.2.255 or 10.1.2.256; +1 (212) 555-0100. 4111 1111-1111 1111 x_y@z.w_q@r.s "),
        (11, "short Text"),
        (12, "short text"),
        (None, a),
        (None, "no id here"),
        (13, "é" * 150 + "ß中😀" * 90),
        (14, "é" * 150 + "ß中😀" * 90 + "x"),
        (14, prose(6, 50)),
        (15, "1" * 3000 + " " + "a" * 5000 + "@"),
    ]


@pytest.fixture(scope="session")
def rows():
    return edge_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 0.5, 7, True, "s") for i, t in rows], COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def items(spark):
    """Benchmark items: long, short, null, empty, repeated, without an id."""
    quote = " ".join(prose(3, 40).split()[5:25])
    found = [(1, quote), (2, "short TEXT"), (3, None), (4, ""), (5, quote), (5, quote), (None, prose(2, 30)), (6, "never said")]
    return found, spark.createDataFrame([(i, t, "x") for i, t in found], "item_id long, text string, Text string")


@pytest.fixture(scope="session")
def labels(spark):
    found = [(i, i % 2, (i // 2) % 2) for i in range(1, 15)] + [(None, 1, 1), (3, None, None), (99, 1, 0), (5, 1, 1)]
    return spark.createDataFrame(found, "doc_id long, quality int, toxic int")
