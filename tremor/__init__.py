"""tremor: PySpark-native cleaning, geocoding, warehousing and OLAP for event catalogs.

Sub-packages:

* ``tremor.functions`` - column expressions (place grammar, numeric casts,
  point-in-polygon) and the fixed lookup values;
* ``tremor.sources``   - event files, county polygons, stand-in test input;
* ``tremor.operators`` - cleaning, spatial join, keys, insert-only loads,
  checks, profile and OLAP operators;
* ``tremor.plans``     - the event pipeline, the warehouse loads, the query
  registry;
* ``tremor.streaming`` - the monthly refresh as a Structured Streaming job.
"""

__version__ = "0.1.0"
