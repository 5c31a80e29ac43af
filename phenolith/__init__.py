"""Geo-temporal feature engine on PySpark.

Public surface: functions from DataFrame (plus parameters) to DataFrame, grouped in

* ``functions``  - Column helpers (dates, keys, geodesy, sun, hashing)
* ``operators``  - joins, windows, aggregations, sampling, features, models
* ``sources``    - scans, key ranges, version listings
* ``sinks``      - category layout, split, fitted state, reports
* ``plans``      - the three end-to-end jobs: enrich, fit, teach
* ``streaming``  - the stateless steps on a streaming frame
"""
