"""helixframe: metagenomics analytics as Spark DataFrame transformations."""
