"""demandops — retail demand and inventory analytics on Spark DataFrames.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, so Catalyst can prune, push down and fuse the whole
chain.  Sub-packages:

* ``sources``   – table readers, the daily sales adapter, stage I/O
* ``operators`` – quality, cleaning, features, evaluation, forecasting,
                  inventory policy, exploration and business reports
* ``functions`` – small column helpers shared by the operators
* ``plans``     – stage composition and the registered query catalogue
"""

SERIES_KEYS = ("store_id", "item_id")
