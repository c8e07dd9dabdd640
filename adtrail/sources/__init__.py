"""adtrail.sources"""
