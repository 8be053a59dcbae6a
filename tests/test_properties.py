"""Property checks: the delimited parser against a model of String.split +
trim + parseInt, and the hash split against the same rule in plain Python."""

import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.functions import hash_bucket
from tessera.sources import parse_delimited

NAMES = st.text(alphabet=st.characters(blacklist_characters=",\n\r", blacklist_categories=("Cs",)), max_size=8)
SPACES = st.sampled_from(["", " ", "  ", "\t"])


def _model(line):
    parts = re.sub(",+$", "", line).split(",")
    if len(parts) < 2:
        return None
    try:
        return parts[0], int(parts[1].strip(" \t"))
    except ValueError:
        return None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(NAMES, st.integers(-10**6, 10**6), SPACES, SPACES), min_size=1, max_size=20))
def test_parse_matches_model(spark, rows):
    lines = [f"{n},{a}{b}{age}{b}" for n, age, a, b in rows]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [(r.name, r.age) for r in parse_delimited(df, [("name", "string", False), ("age", "int", True)],
                                                    strict=False).collect()]
    for line, (name, age) in zip(lines, got):
        m = _model(line)
        assert (name, age) == m


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(0, 10**12), min_size=1, max_size=30))
def test_hash_bucket_matches_python(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r.b for r in df.select(hash_bucket("k").alias("b")).collect()]
    assert got == [int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16) % 10 for k in keys]
