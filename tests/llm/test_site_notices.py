from siltstone.llm import boilerplate
from tests.llm.test_text_operators import PAGES


def test_long_notices_are_counted(spark):
    notice = "Alpha Holding, Beta Works, Gamma Labs, Delta Trade: registered offices " + ", ".join(f"Place {k}" for k in range(20))
    rows = [(i, "s", f"Head {i}", "text/plain", None, [("paragraph", notice, [])], "k", "t") for i in range(4)]
    found = boilerplate.site_frequency(spark.createDataFrame(rows, PAGES)).first()["frequent"]
    assert len(notice) > 160 and boilerplate.site_key(notice) in found
