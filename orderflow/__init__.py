"""Spark jobs for food-order data: loading, reports, validation and fraud alerts.

Every public function takes DataFrames (or a session) and returns DataFrames;
none of them builds, configures or stops a session.
"""
