"""strata: layered (Bronze -> Silver -> Gold -> gate) table operators on Spark.

Every operator is a DataFrame -> DataFrame function built on the public
DataFrame / SQL API.  Nothing in the data path collects to the driver; the
only driver-side values are tiny check results read by the quality gate.
"""

from strata.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
