"""mercato: a PySpark-native commerce analytics library.

Raw order / item / payment / review / customer / product / seller files go
through schema contracts and quality gates into bronze and silver layers;
silver feeds a star schema (four dimensions, two facts), metric marts and the
read-side queries of a dashboard.  Every builder is a pure
``DataFrame -> DataFrame`` function; actions only happen in sinks and in the
pipeline driver (``mercato.plans.pipeline``).
"""

__version__ = "0.1.0"
