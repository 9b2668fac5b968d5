"""Chat analytics on Spark: layered tables, per-user activity, platform metrics and live streams.

Every transform is a pure ``DataFrame -> DataFrame`` function built from native expressions. "Today" is always
an explicit ``as_of`` argument, so a run can be repeated and checked. Run sessions with
``spark.sql.session.timeZone=UTC``; dates are derived from timestamps in the session zone.
"""
