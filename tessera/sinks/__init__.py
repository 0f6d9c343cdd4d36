"""Writers of tables, labels, images, masks, annotation documents and logs."""
