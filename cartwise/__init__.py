"""Spark-native purchase analytics and next-category recommendation.

Every public function takes DataFrames and returns DataFrames. Nothing here
keeps a global session, and no function moves row-sized data to the driver.
"""
