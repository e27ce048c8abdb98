"""Fleet telemetry analytics on Spark: lazy DataFrame operators over vehicle positions, timetables and KPIs."""

__version__ = "0.1.0"
