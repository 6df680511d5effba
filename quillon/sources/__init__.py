"""Tables in and out: schemas, readers, the weekly sample adapter, sinks."""
