"""The relations of the storefront, each a function from frames to a frame."""
