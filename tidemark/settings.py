"""Session settings suggested for large clusters.

None of them changes a result. Pass them to ``SparkSession.builder.config`` or to
``spark-submit``; ``spark.checkpoint.dir`` comes from the cluster.
"""

CLUSTER_SETTINGS = {
    # Re-plan joins and partition sizes from what a stage really produced.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Start with many shuffle partitions; adaptive execution merges small ones.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    # Split uneven partitions of joins whose sides both come straight from a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let a small cohort filter event scans before their shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # A filter of 8 MB, good for four million admissions, whatever the size of the table it is made from.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}
