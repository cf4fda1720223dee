"""Retail-inventory analytics on Spark: loads, reporting marts, KPIs and a forecast-bias model.

Every function takes and returns DataFrames (or Columns); only ``shelfline.sources`` and
``shelfline.streaming`` touch storage.
"""
