"""The in-row pairing rule against a line-by-line walk, on random line sequences."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lapline.operators.parse import parse_sheets

LINES = {
    "S": "{n} 1 DOE Jane USA 0.70 4:0{d}.00",
    "P": "50m 2{d}.00 100m 5{d}.00",
    "B": "{n} 2 ROE Ann USA 0.71 4:1{d}.00 50m 2{d}.50",
    "N": "Legend {d}",
    "E": "",
}


def walk(kinds):
    """Expected (rank, split_50m) per swimmer: a swimmer line takes the next
    swimmer-or-splits line as its splits when that line holds splits, and a
    line taken that way is not read again."""
    lines = [(k, i) for i, k in enumerate(kinds) if k in "SPB"]
    out, i = [], 0
    while i < len(lines):
        kind, idx = lines[i]
        if kind in "SB":
            split = None
            if i + 1 < len(lines) and lines[i + 1][0] in "PB":
                nk, nidx = lines[i + 1]
                split = f"2{nidx % 10}.00" if nk == "P" else f"2{nidx % 10}.50"
                i += 1
            out.append((idx + 1, split))
        i += 1
    return sorted(out)


def render(kinds):
    return "\n".join(LINES[k].format(n=i + 1, d=i % 10) for i, k in enumerate(kinds)) + "\n"


@settings(max_examples=60, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("SPBNE"), max_size=12), min_size=1, max_size=8))
def test_pairing_matches_walk(spark, docs):
    rows = [(f"d{i}", render(k)) for i, k in enumerate(docs)]
    df = spark.createDataFrame(rows, "Link string, text string")
    got = {}
    for r in parse_sheets(df).collect():
        got.setdefault(r.Link, []).append((r.rank, r.split_50m))
    for i, k in enumerate(docs):
        assert sorted(got.get(f"d{i}", [])) == walk(k), (k, got.get(f"d{i}"))

