"""The report sections come in the order that the text asks for."""

import pytest

from tallyforge.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
ORDER = {"report_trade_timeline": (("year", 1), ("quarter", 1)), "report_security_structures": (("effectiveness_rate", -1),),
         "report_security_zones": (("vulnerability_score", -1),), "report_security_readiness": (("readiness_score", -1),),
         "report_security_evolution": (("year", 1),)}


@pytest.mark.parametrize("key", sorted(ORDER))
def test_section_is_sorted(spark, key):
    rows = QUERIES[key][0](spark, SF).collect()
    got = [tuple(sign * r[c] for c, sign in ORDER[key]) for r in rows if all(r[c] is not None for c, _ in ORDER[key])]
    assert got == sorted(got)
