"""A key or partition value holding a large share of all rows."""

from conftest import GOOD, record_line

from regline.operators.quality import dedupe
from regline.plans.ingest import ingest
from regline.sinks.tables import rows_per_file
from regline.sources.text import read_lines
from regline.operators.records import accepted, classify


def skewed_release(write_files, n=3000):
    """A third of the lines share one id (with different content); two thirds share uf SP."""
    files = {}
    for f in range(3):
        lines = []
        for i in range(f, n, 3):
            raiz = "00000001" if i % 3 == 0 else f"{i + 10:08d}"
            uf = "SP" if i % 3 != 2 else f"U{i % 7}"
            lines.append(record_line({**GOOD, 0: raiz, 4: f"Nome {i:05d}", 32: uf}))
        files[f"Empresas{f}.csv"] = b"\r\n".join(lines) + b"\r\n"
    return write_files(files)


def test_hot_key_keeps_exactly_one_winner(spark, write_files):
    root = skewed_release(write_files)
    recs = accepted(classify(read_lines(spark, root)), lineage=True)
    out = dedupe(recs)
    hot = out.where("cnpj = '00000001000211'").collect()
    assert len(hot) == 1
    # The smallest (file, line) wins: Empresas0.csv holds every hot line; its
    # smallest line text is the one with the smallest name.
    assert hot[0].razao_social == "Nome 00000"
    assert out.count() == 1 + 2000


def test_hot_key_with_shuffled_key_list(spark, write_files):
    root = skewed_release(write_files)
    recs = accepted(classify(read_lines(spark, root)), lineage=True)
    want = sorted(map(tuple, dedupe(recs).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got = sorted(map(tuple, dedupe(recs).collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want


def test_hot_partition_value_is_split_across_files(spark, tmp_path):
    """AQE cuts a hot uf along map outputs, so the input has many map tasks."""
    from regline.layout import EMPRESAS
    from regline.sinks.tables import write_partitioned

    df = spark.range(0, 60000, 1, 12).selectExpr(
        "lpad(cast(id as string), 14, '0') as cnpj",
        "if(id % 3 = 0, concat('U', cast(id % 7 as string)), 'SP') as uf",
        "concat('62', cast(id % 5 as string)) as cnae_fiscal",
        *[f"cast(null as string) as {c}" for c in EMPRESAS.names if c not in ("cnpj", "uf", "cnae_fiscal")],
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        path = str(tmp_path / "t")
        write_partitioned(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = rows_per_file(spark, path).collect()
    sp = [r.rows for r in files if "uf=SP" in r.file_path]
    assert sum(sp) == 40000
    assert len(sp) > 1  # the hot value was cut into several tasks, not one
