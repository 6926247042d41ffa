"""A commercial analytics engine on Spark: sources, conformed datasets, marts, reports, documents, streams; see README.md."""
