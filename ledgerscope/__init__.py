"""ledgerscope: credit-default analytics as Spark DataFrame operators.

Every public operator takes a DataFrame (plus parameters) and returns a DataFrame,
so it can be chained with ``DataFrame.transform``. Nothing collects rows to the
driver; the few driver-side values (model coefficients, scaler statistics, PSI edges)
are bounded by the number of features, never by the number of rows.
"""

from ledgerscope.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
