"""Marts, reports, exports and the daily job."""
