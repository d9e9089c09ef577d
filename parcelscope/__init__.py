"""parcelscope: order-fulfilment analytics on Spark.

Raw tables -> typed clean tables plus a quarantine -> delivery-performance
questions and data-quality profiles, all as lazy DataFrame plans.
"""

__version__ = "0.1.0"
