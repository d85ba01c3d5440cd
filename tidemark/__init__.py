"""tidemark: customer analytics as Spark jobs.

Every public operator takes DataFrames and returns a DataFrame; the heavy
work stays inside Spark (DataFrame / SQL / window / ML), and only tiny
aggregated rows (a few numbers per test or per bucket) ever reach the driver.
"""

from tidemark.session import build_session, checkpoint_dir  # noqa: F401

AS_OF = "2024-01-01"
