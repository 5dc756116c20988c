from fleetspark.plans import measures, registry


def test_an_anomalous_day_stands_out(spark):
    rows = [("aws", 20240000 + i, 100.0 + i % 2) for i in range(1, 32)] + [("aws", 20240032, 500.0), ("gcp", 20240001, 7.0)]
    daily = spark.createDataFrame(rows, "cloud string, date_key int, cost double")
    got = {(r["cloud"], r["date_key"]): r for r in measures.cost_anomalies(daily, ["cloud"]).collect()}
    assert got["aws", 20240032]["z_score"] > 100 and abs(got["aws", 20240031]["z_score"]) < 2
    assert got["aws", 20240030]["baseline_period"] and not got["aws", 20240031]["baseline_period"]
    assert got["gcp", 20240001]["z_score"] is None


def test_anomaly_scores_are_a_query(spark, sf_dir):
    assert "z_score" in registry.queries()["cost_anomaly_scores"](spark, sf_dir).columns
