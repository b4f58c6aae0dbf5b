"""tabwise: everyday tabular analytics expressed as Spark DataFrame plans.

Every public operator takes and returns a ``DataFrame`` (or a ``Column``) and
is built from Spark's own expressions, so a pipeline stays one lazy plan that
Catalyst optimises and that runs unchanged from local mode to a cluster.
"""

from tabwise.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
