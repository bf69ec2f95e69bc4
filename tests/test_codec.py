import math
import random
import struct

import numpy as np
import pytest
import xxhash

from fileledger.operators import codec as K


def signals(spark, by_name):
    rows = [(s, i, float(x)) for s, xs in by_name.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "signal_id string, idx long, value double")


def bits(xs):
    return [struct.pack("<d", x) for x in xs]


@pytest.fixture(scope="module")
def given():
    rng = np.random.default_rng(42)
    r = random.Random(7)
    return {
        "grid": (-0.31 + rng.integers(-2000, 2000, 3000) * 1.25e-4).tolist(),
        "normal": np.random.default_rng(7).normal(size=1500).tolist(),
        "constant": [0.125] * 500,
        "wide": [0.0, 1.0, float(2**25)] + [float(r.randint(0, 2**25)) for _ in range(300)],
        "zeros": [0.0, -0.0, 1.0, 2.0] * 20,
        "nan": [float("nan"), 1.0, 2.0, float("inf")] * 10,
        "off": [0.0, 1.0, 2.0, 3.37] * 30,
        "one": [5.5],
        "only_nan": [float("nan")] * 3,
        "only_inf": [float("-inf")] * 2,
    }


def test_round_trips(spark, given):
    s = signals(spark, given).repartition(4)
    codes, meta, levels = K.encode_signals(s)
    m = {r.signal_id: r for r in meta.collect()}
    assert [k for k, v in m.items() if not v.exact] == ["zeros"] and all(v.n_samples == len(given[k]) and v.max_abs_error == 0 for k, v in m.items())
    assert {k: v.encoding for k, v in m.items()} == {"grid": m["grid"].encoding, "normal": "indexed", "constant": "affine_codes", "wide": "indexed", "zeros": "indexed", "nan": "indexed", "off": "indexed", "one": "affine_codes", "only_nan": "indexed", "only_inf": "indexed"}
    assert m["grid"].bits_per_sample == 16 and m["constant"].step == 1.0
    back = {}
    for r in K.decode(codes, meta, levels).orderBy("signal_id", "idx").collect():
        back.setdefault(r.signal_id, []).append(r.value)
    for name, xs in given.items():
        if name != "zeros":
            assert bits(back[name]) == bits(xs), name
    report = {r.signal_id: r for r in K.roundtrip_report(s, K.decode(codes, meta, levels)).collect()}
    assert [k for k, r in report.items() if not r.exact] == ["zeros"]
    # what isn't exact has no codes at all, unless the caller takes losses
    assert all(r.n_samples == len(given[k]) and r.n_decoded == (0 if k == "zeros" else len(given[k])) for k, r in report.items())
    lossy = {r.signal_id: r for r in K.roundtrip_report(s, K.decode(*K.encode_signals(s, exact=False))).collect()}
    assert lossy["zeros"].n_decoded == len(given["zeros"]) and lossy["zeros"].max_abs_error == 0


def test_published_signals_are_whole_or_absent(spark, given, tmp_path, monkeypatch):
    s = signals(spark, {k: given[k] for k in ("grid", "off", "nan")})
    expected = K.signal_xxh64(s)
    coded = K.encode_signals(s)
    at = f"file://{tmp_path}/out"
    assert K.publish_rebuilt(*coded, expected, at).where("ok").count() == 3
    assert {tuple(r) for r in K._against(spark.read.parquet(at), expected).select("signal_id", "ok").collect()} == {("grid", True), ("off", True), ("nan", True)}
    with pytest.raises(FileExistsError):
        K.publish_rebuilt(*coded, expected, at)
    real = K.rebuild_signals

    def damaged(*args):
        good, result = real(*args)
        return good.withColumn("value", K.F.when((K.F.col("signal_id") == "off") & (K.F.col("idx") == 0), 9.0).otherwise(K.F.col("value"))), result

    monkeypatch.setattr(K, "rebuild_signals", damaged)
    errors = {r.signal_id: r.error for r in K.publish_rebuilt(*coded, expected, f"file://{tmp_path}/second").collect()}
    assert errors["off"] == "reads back differently" and not (tmp_path / "second").exists() and not (tmp_path / "second.part").exists()


def test_lost_samples_are_not_exact(spark):
    s = signals(spark, {"a": [1.0, 2.0, 3.0]})
    r = K.roundtrip_report(s, s.where("idx < 2")).first()
    assert not r.exact and r.max_abs_error == math.inf and r.n_decoded == 2


def test_fit_is_that_of_numpy(spark, given):
    fit = {r.signal_id: r for r in K.fit_grid(K.signal_levels(signals(spark, given))).collect()}
    u = np.unique(np.array(given["grid"]))
    k = np.rint((u - u[0]) / np.diff(u).min())
    assert fit["grid"].on_grid and math.isclose(fit["grid"].step, float(k @ (u - u[0]) / (k @ k)), rel_tol=1e-12)
    assert not fit["off"].on_grid and not fit["nan"].on_grid and fit["wide"].on_grid


def test_bits(spark):
    rows = [(a, b) for a in (0, -1, -2, -3, -128, -129, -32768, -32769) for b in (0, 1, 2, 127, 128, 32767, 32768, 2**23 - 1, 2**23)]

    def width(a, b):
        n = 2
        while a < -(2 ** (n - 1)) or b > 2 ** (n - 1) - 1:
            n += 1
        return n

    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", K.bits_for_codes(K.F.col("a"), K.F.col("b")).alias("w"))
    assert all(r.w == width(r.a, r.b) for r in df.collect())


def test_lossy(spark):
    s = signals(spark, {"a": [0.0, 0.5, -1.0, 0.25], "z": [0.0, 0.0]})
    got = {(r.signal_id, r.idx): r.code for r in K.fixed_point_codes(s).collect()}
    assert got == {("a", 0): 0, ("a", 1): 4194304, ("a", 2): -8388607, ("a", 3): 2097152, ("z", 0): 0, ("z", 1): 0}


def test_hash_and_rebuild(spark, given):
    s = signals(spark, given).repartition(5)
    want = {k: xxhash.xxh64_hexdigest(np.array(v, "<f8").tobytes()) for k, v in given.items()}
    got = {r.signal_id: r.data_xxh64 for r in K.signal_xxh64(s).collect()}
    assert got == want
    expected = spark.createDataFrame([(k, h if k != "off" else "0" * 16) for k, h in want.items()] + [("none", "1" * 16)], "signal_id string, data_xxh64 string")
    rebuilt, result = K.rebuild_signals(*K.encode_signals(s), expected)
    bad = {r.signal_id: r.error for r in result.collect() if not r.ok}
    assert set(bad) == {"off", "zeros", "none"} and bad["none"] == "no samples"
    assert {r.signal_id for r in rebuilt.select("signal_id").distinct().collect()} == set(given) - {"off", "zeros"}
    rows, totals = K.audit_codec(s, spark.createDataFrame([("grid",), ("zeros",), ("none",)], "signal_id string"))
    assert tuple(totals.first()) == (1, 1, 1)


def test_channels_and_route(spark):
    from fileledger.schema import with_defaults

    p = lambda **kw: {k: ("np", "float64", v) for k, v in kw.items()}
    ok = p(wf_increment="2e-05", wf_start_time="t")
    rows = [("a.tdms", "g", "c", ok), ("b.tdms", "g", "c", ok), ("b.tdms", "g", "d", ok), ("c.tdms", "g", "c", ok), ("c.tdms", "h", "d", ok), ("d.tdms", "g", "c", {**ok, **p(NI_Scaling_Status="x")}), ("e.tdms", "g", "c", p(wf_increment="1")), ("f.tdms", "g", "c", p(wf_increment="-1", wf_start_time="t")), ("h.tdms", "g", "c", p(wf_increment="1e-9", wf_start_time="t"))]
    ch = spark.createDataFrame(rows, "file_path string, group_name string, channel_name string, properties map<string, struct<t: string, dt: string, v: string>>")
    led = with_defaults(spark.createDataFrame([(f"{x}.tdms", ".tdms", 20 << 20) for x in "abcdefhk"] + [("s.tdms", ".TDMS", 100), ("x.csv", ".csv", 20 << 20)], "file_path string, file_extension string, file_size_bytes bigint"))
    e = K.codec_eligibility(led, ch)
    got = {r.file_path: r.decline_reason for r in e.collect()}
    assert got == {"a.tdms": None, "b.tdms": "channels", "c.tdms": "groups", "d.tdms": "scaling_properties", "e.tdms": "no_timing", "f.tdms": "increment", "h.tdms": "sample_rate", "k.tdms": "unreadable", "s.tdms": "too_small", "x.csv": "extension"}
    assert K.codec_eligibility(led, ch, enabled=False).select("decline_reason").distinct().collect()[0][0] == "switched_off"
    routes = {r.file_path: (r.route, r.reason) for r in K.route(e, spark.createDataFrame([("a.tdms", False)], "file_path string, exact boolean")).collect()}
    assert routes["a.tdms"] == ("plain", "not_exact") and routes["b.tdms"] == ("plain", "declined: channels")
    assert K.route(e, spark.createDataFrame([], "file_path string, exact boolean")).where("file_path = 'a.tdms'").first().reason == "fallback_empty"
