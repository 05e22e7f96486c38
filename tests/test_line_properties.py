"""Property test: Spark's line scan + split against a plain model of the
reference's rules, on random bytes made of the awkward characters."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from regline.functions.columns import split_fields
from regline.sources.text import read_lines


def model_lines(data: bytes) -> list[str]:
    """Lines end at LF; one CR right before it is dropped; the last line needs
    no LF and loses one trailing CR; zero-length lines are dropped."""
    out, start = [], 0
    for i, b in enumerate(data):
        if b == 0x0A:
            end = i - 1 if i > 0 and data[i - 1] == 0x0D else i
            if end > start:
                out.append(data[start:end])
            start = i + 1
    if start < len(data):
        end = len(data) - 1 if data[-1] == 0x0D else len(data)
        if end > start:
            out.append(data[start:end])
    return [x.decode("latin-1") for x in out]


blobs = st.lists(
    st.lists(st.sampled_from([b"a", b"\xe7", b";", b"\r", b"\n", b" ", b'"', b"\r\n"]), max_size=40).map(b"".join),
    min_size=1,
    max_size=25,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files=blobs)
def test_scan_and_split_match_the_model(spark, tmp_path_factory, files):
    d = tmp_path_factory.mktemp("prop")
    for i, data in enumerate(files):
        (d / f"f{i}.csv").write_bytes(data)
    rows = read_lines(spark, str(d)).select("file_name", "line", split_fields("line").alias("f")).collect()
    got: dict[str, list] = {}
    for r in rows:
        got.setdefault(r.file_name, []).append((r.line, list(r.f)))
    for i, data in enumerate(files):
        expected = sorted((line, line.split(";")) for line in model_lines(data))
        assert sorted(got.get(f"f{i}.csv", [])) == expected, data


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files=blobs)
def test_zip_members_match_the_model_across_chunk_edges(spark, tmp_path_factory, files):
    import zipfile

    from regline.sources.archives import plan_archives, read_planned_raw
    from regline.sources.text import lines_from_raw

    d = tmp_path_factory.mktemp("propzip")
    with zipfile.ZipFile(d / "Empresas0.zip", "w") as zf:
        for i, data in enumerate(files):
            zf.writestr(f"f{i}.csv", data)
    # 3-byte reads put chunk boundaries everywhere, including inside CR LF.
    raw = read_planned_raw(spark, plan_archives(spark, [f"file:{d}/Empresas0.zip"]), chunk_bytes=3)
    rows = lines_from_raw(raw).collect()
    got: dict[str, list] = {}
    for r in rows:
        got.setdefault(r.file_name, []).append(r.line)
    for i, data in enumerate(files):
        assert sorted(got.get(f"f{i}.csv", [])) == sorted(model_lines(data)), data


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files=blobs, split=st.integers(min_value=1, max_value=12))
def test_stored_members_split_by_byte_range_match_the_model(spark, tmp_path_factory, files, split):
    import zipfile

    from regline.sources.archives import plan_archives, read_planned_raw
    from regline.sources.text import lines_from_raw

    d = tmp_path_factory.mktemp("propstored")
    with zipfile.ZipFile(d / "Empresas0.zip", "w", compression=zipfile.ZIP_STORED) as zf:
        for i, data in enumerate(files):
            zf.writestr(f"f{i}.csv", data)
    # Tiny splits: every member above `split` bytes is read by several tasks.
    plan = plan_archives(spark, [f"file:{d}/Empresas0.zip"], split_bytes=split)
    raw = read_planned_raw(spark, plan, chunk_bytes=2)
    rows = lines_from_raw(raw).collect()
    got: dict[str, list] = {}
    for r in rows:
        got.setdefault(r.file_name, []).append(r.line)
    for i, data in enumerate(files):
        assert sorted(got.get(f"f{i}.csv", [])) == sorted(model_lines(data)), (data, split)
