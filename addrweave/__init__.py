"""Address and street conflation as Spark DataFrame operators."""
