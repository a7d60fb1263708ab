"""The registered queries and their SQL twins."""


def load():
    from presslens.catalog import extraction, flagship, models, registry, scalars, storage, text  # noqa: F401

    return registry.QUERIES, registry.twins()
