"""Contact-centre analytics warehouse expressed as PySpark DataFrame transformations."""
