from conftest import ids, owned

from shelfwise.api import Shelf


def _jobs(spark):
    """Spark jobs started so far."""
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_facade(shop, tmp_path):
    shop.save(str(tmp_path / "cat"))
    shelf = Shelf.load(shop.products.sparkSession, str(tmp_path / "cat"))
    assert ids(shelf.search("best_sellers", category="Garden", n=2)) == ["G-30", "G-31"]
    assert shelf.category_stats().count() == 4
    assert shelf.product_details("K-10").first().review_count == 4
    assert [r.product_id for r in shelf.user_history("dan").collect()] == ["K-10", "T-51", "G-32"]
    assert shelf.system_info().first().unique_users == 5
    assert shelf.copurchasers("ada", "K-10").first().copurchasers == 2
    assert ids(shelf.also_bought("K-11")) == ["K-10"]
    assert shelf.user_similarity("ben", "cleo").first().similarity == 0.25
    assert {r.product_id for r in shelf.collaborative(user_id="ben").collect()} == (
        owned()["ada"] | owned()["dan"] | owned()["cleo"]) - owned()["ben"] - {"gone-9"}
    assert shelf.recommendations(n=1).first().product_id == "G-30"
    assert {r.product_id for r in shelf.similar_in_band("G-30").collect()} == {"G-31"}
    assert shelf.fit().edges_of("K-11").count() == 1
    r = shelf.evaluate(0.5).first()
    assert 0 <= r.precision_at_k <= 1


def test_single_key_calls_start_no_job(shop):
    spark = shop.products.sparkSession
    shelf = Shelf(shop)
    before = _jobs(spark)
    for call in (lambda: shelf.collaborative(user_id="ben"), lambda: shelf.collaborative(product_id="K-10"),
                 lambda: shelf.also_bought("K-10"), lambda: shelf.user_similarity("ben", "ada"),
                 lambda: shelf.recommendations(user_id="ben"), lambda: shelf.recommendations(product_id="G-31"),
                 lambda: shelf.recommendations(), lambda: shelf.similar_in_band("K-10"), lambda: shelf.user_history("ada"),
                 lambda: shelf.copurchasers("ada", "K-10"), lambda: shelf.product_details("K-10"),
                 lambda: shelf.search("top", n=3), lambda: shelf.system_info()):
        call()
    assert _jobs(spark) == before
