"""Sessions with slices of two or three rows against the replays, on generated logs."""

import os
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from test_sessions import HEART, REPLAY, T0, schema_of

from studytrail.operators import sessions as S

EXAMPLES = int(os.environ.get("PROPERTY_EXAMPLES", "8"))

rows = st.lists(
    st.tuples(
        st.integers(1, 3), st.integers(0, 1), st.integers(0, 1), st.integers(0, 1), st.sampled_from([0, 1, 2, None]), st.integers(0, 6)
    ),
    max_size=25,
)
beats = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 1), st.integers(0, 1), st.integers(0, 1), st.integers(0, 6)), max_size=8)


@pytest.mark.parametrize("mode", ["clean", "compat"])
@pytest.mark.parametrize("spec", [S.LOGIN, S.VIDEO], ids=lambda s: s.name)
def test_small_slices(spark, spec, mode):
    @settings(max_examples=EXAMPLES, deadline=None, database=None, derandomize=True, suppress_health_check=list(HealthCheck))
    @given(rows, beats, st.integers(2, 3))
    def check(drawn, drawn_beats, limit):
        log = []
        for i, (uid, cid, rid, rt, at, minute) in enumerate(drawn, 1):
            known = {"id": i, "uid": uid, "cid": cid, "rid": rid, "rt": rt, "at": at, "sp": float(i % 5)}
            known["ct"] = T0 + timedelta(minutes=minute)
            log.append(tuple(known.get(c, i) for c in spec.log_columns))
        pulse = [(*b[:4], T0 + timedelta(minutes=b[4])) for b in drawn_beats]
        got = S.sessionize(
            spark.createDataFrame(log, schema_of(spec)),
            spark.createDataFrame(pulse, HEART),
            spec,
            mode,
            rows_per_slice=limit,
        )
        assert sorted(map(tuple, got.collect())) == REPLAY[mode](spec, log, pulse)

    check()
