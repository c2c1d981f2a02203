"""The stage jobs chained as in the reference's workflow: collect -> parse -> geo ->
filter (per type) -> extract, and store."""

import json

from rrspark.cli import main
from rrspark.plans.fixtures import fixture
from rrspark.plans.messages import answers_with_wire
from rrspark.session import scratch_path


def test_stage_jobs_chain(spark, sf_dir, capsys):
    base = scratch_path(spark, "cli")
    domains, answers, blocks = f"{base}/domains", f"{base}/answers", f"{base}/blocks"
    fixture(spark, sf_dir, "rr").selectExpr("regexp_replace(name, '\\\\.$', '') AS value").distinct() \
        .write.text(domains)
    answers_with_wire(spark, sf_dir).write.parquet(answers)
    fixture(spark, sf_dir, "blocks").write.parquet(blocks)

    main(["collect", "A,MX,TXT", domains, f"{base}/raw", "--answers", answers], spark)
    totals = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert totals["num_requests"] == 3 * spark.read.text(domains).count()
    assert totals["responses"] > 0 and totals["request_timeouts"] > 0

    main(["dump", f"{base}/raw", f"{base}/dump"], spark)
    first = spark.read.text(f"{base}/dump").first().value
    assert "\t" in first and ': {"opcode":"QUERY"' in first
    main(["parse", f"{base}/raw", f"{base}/parsed"], spark)
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["parse_failures"] == 0
    main(["geo", f"{base}/parsed", f"{base}/geo", "--blocks", blocks], spark)
    main(["filter", "type = 'MX'", f"{base}/geo", f"{base}/mx"], spark)
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["matched"] > 0 and counts["non_matched"] > 0
    main(["extract", "CASE WHEN NOT (target rlike '^\\\\d{1,3}(\\\\.\\\\d{1,3}){3}\\\\.$') THEN lower(target) END",
          f"{base}/mx", f"{base}/mail"], spark)
    vals = {r.value for r in spark.read.parquet(f"{base}/mail").collect()}
    assert vals and all(v.startswith("mx") and v == v.lower() for v in vals)

    main(["store", f"{base}/geo", f"{base}/cells", "--events", "ev:dns", "--edges", "eg:dns:name:addr"], spark)
    tables = {r.table_name for r in spark.read.parquet(f"{base}/cells").select("table_name").distinct().collect()}
    assert tables == {"ev", "eg"}
    main(["filter", "type IS NOT NULL", f"{base}/geo", f"{base}/by_type", "--by-type"], spark)
    assert spark.read.parquet(f"{base}/by_type").where("type = 'SOA'").count() > 0
